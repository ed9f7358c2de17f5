import random

from quillstone.llm import encoding_repair, leakage

ITEMS = [(i, " ".join(f"{w}{i}" if k % 4 == 0 else w for k, w in enumerate("the old clerk wrapped a silver token near the dock while nobody saw the lantern and paid nine marks Question: which token did the clerk reach".split()))) for i in range(1, 40)]


def test_retrieval_is_complete():
    index = leakage.ItemIndex(ITEMS, 10)
    rng = random.Random(3)
    filler = "when firewall rules mask the login forms of the staging host and nobody saw".split()
    for _ in range(200):
        i, text = rng.choice(ITEMS)
        ws = text.split()
        n = rng.randint(6, 14)
        at = rng.randint(0, len(ws) - n)
        doc = rng.choices(filler, k=rng.randint(0, 90)) + ws[at : at + n] + rng.choices(filler, k=rng.randint(0, 90))
        words = leakage.words(" ".join(doc))
        want = {j for j, t in ITEMS for w in [leakage.words(t)] if {tuple(w[k : k + 10]) for k in range(len(w) - 9)} & {tuple(words[k : k + 10]) for k in range(len(words) - 9)}}
        assert {m[0] for m in index.matches(" ".join(doc))} == want
        assert (i in want) or n < 10


def test_marks_case_and_accents_do_not_count(spark):
    items = spark.createDataFrame([(7, "Décrivez une lanterne pliée près du quai neuf avant la nuit noire"), (8, None), (9, "too short")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x **DECRIVEZ** une\n> lanterne <b>pliee</b> pres, du quai neuf avant la nuit!", "q"), (2, None, "q"), (3, "", "q"), (4, "Décrivez une lanterne pliée", "q")], "doc_id bigint, text string, item_id string")
    got = leakage.leaked_items(docs, items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 7)]
    assert leakage.leaked_items(docs.where("false"), items).count() == 0
    assert leakage.leaked_items(docs, items.where("false")).count() == 0


CLEAN = "Für die Prüfsummen gilt: das Café öffnet später, “sagt” der Prüfer. L’été à la forêt, où l’on s’amuse. El niño pequeño también llegó."


def test_garbled_documents(spark):
    rows = [(i, CLEAN) for i in range(1, 21)]
    garbled = {
        101: "FÃ¼r die PrÃ¼fsummen gilt", 102: "Das CafÃƒÂ© Ã¶ffnet", 103: "F├╝r die Pr├╝fsummen", 104: "Pr�fsummen gilt", 105: "die Pr?fsummen", 106: "Prьfsummen", 107: "F\x81r die Pr\x81fsummen",
    }
    clean = {201: "Als Latin-1 gelesen wird aus ü die Folge „Ã¼“.", 202: "Kommt er? Ja.", 203: None, 204: "", 205: "the sign is “�”.", 206: "see page?id=3"}
    # a rare token of a frequent word, while a garbled form of the word is frequent too
    garbled |= {i: "die Prьfsummen gelten" for i in range(301, 305)}
    garbled |= {401: "a tool may turn the pair â€œÃƒÂ©â€\x9d into a dash", 402: "the dash â€œÃ¢â‚¬â€œâ€\x9d; and so on"}  # quotation marks are garbled themselves
    clean |= {208: "a tool may turn the pair “Ã©” into a dash", 209: "the dash “â€“”; and so on"}
    clean |= {207: "der Prüfsummen</think> wegen"}
    df = spark.createDataFrame(rows + [*garbled.items(), *clean.items()], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in encoding_repair.garbled_documents(df).collect()}
    assert set(got) == set(garbled)
    assert got[101] == "Für die Prüfsummen gilt" and got[102] == "Das Café öffnet" and got[103] == "Für die Prüfsummen"
    assert got[104] == "Prüfsummen gilt" and got[105] == "die Prüfsummen" and got[106] == "Prüfsummen" and got[107] == "Für die Prüfsummen"
    assert encoding_repair.garbled_documents(df.where("false")).count() == 0


def test_copies_do_not_hide_a_garbled_document(spark):
    rows = [(i, f"{CLEAN} {i}") for i in range(1, 21)]
    for garbled in ("die Pr?fsummen gelten", "die PrŸfsummen gelten", "die PrÃ¼fsummen gelten"):
        for copies in (1, 10):
            df = spark.createDataFrame(rows + [(100 + i, garbled) for i in range(copies)], "doc_id bigint, text string")
            got = {r.doc_id: r.text for r in encoding_repair.garbled_documents(df).collect()}
            assert got == {100 + i: "die Prüfsummen gelten" for i in range(copies)}


def test_lattice_decodes_each_code_page():
    channel = encoding_repair.Channel({c: 50 for c in "äöüßéèñ’“”€"})
    for page in ("latin-1", "cp850", "cp437", "mac_roman"):
        assert channel.decode_utf8("Prüfgröße".encode().decode(page)) == "Prüfgröße"
    assert channel.decode_utf8("Prüfgröße") == "Prüfgröße"


def test_partial_losses_are_found_and_restored(spark):
    """A word that lost only some of its letters, lost bytes inside UTF-8 read in a code page, a letter lost at a word's begin."""
    rows = [(i, f"Die prüfungsmäßige Übersicht war früher größer, où l’été était près {i}.") for i in range(1, 41)]
    garbled = {
        101: ("eine pr?fungsmäßige Liste", "eine prüfungsmäßige Liste"), 102: ("eine pr\ufffdfungsmäßige Liste", "eine prüfungsmäßige Liste"), 103: ("eine pr\ufffdfungsm\ufffd\ufffdige Liste", "eine prüfungsmäßige Liste"),
        104: ("war fr?her da", "war früher da"), 105: ("die ?bersicht fehlt", "die Übersicht fehlt"), 106: ("PR?FUNGSMÄSSIG fr?her", "PR?FUNGSMÄSSIG früher"), 107: ("prÃ¼fungsmÃ\ufffdÃŸige", "prüfungsmäßige"),
    }
    df = spark.createDataFrame(rows + [(i, t) for i, (t, _) in garbled.items()] + [(201, "war er da?oder nicht"), (202, "a?b:c")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in encoding_repair.garbled_documents(df).collect()}
    assert got == {i: t for i, (_, t) in garbled.items()}
    assert sorted(r.doc_id for r in encoding_repair.garbled_ids(df).collect()) == sorted(garbled)


def test_the_more_frequent_word_wins():
    """Of several words with the same gaps the search takes the most frequent, and a path's words decide between channels."""
    channel = encoding_repair.Channel({c: 50 for c in "äöüé"})
    words = {"möchte": ("möchte", 90), "mächte": ("Mächte", 7)}
    lattice = encoding_repair.Lattice("M\ufffdchte", channel, words, 1000)
    _, path, least, known = lattice.best("utf-8")
    assert known and least == 90 and lattice.cased(path) == "Möchte"
