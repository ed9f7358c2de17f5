"""Problem 10: text garbled by a wrong character encoding (noisy-channel decoding over byte lattices)."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import cut, salted_join

LOST = "\ufffd"
#: A token: a run without ASCII white space, with guillemets set off by spaces.
_TOKEN = re.compile("(?:«[ \\t\u00a0\u202f]+)?[^ \\t\\n\\x0b\\f\\r]+(?:[ \\t\u00a0\u202f]+»)?")
#: A question mark inside or before a word.
_MARKED = regex.compile("\\p{L}\\?\\p{L}|(?<![^(\u201c\"'])\\?\\p{Ll}")
_WORD = re.compile(r"(?:[^\W\d_]|[\u0300-\u036f\ufffd]|(?<=[^\W\d_\ufffd])[’'](?=[^\W\d_\ufffd]))+")
_LOSSY = re.compile(r"(?<=[^\W\d_])\?(?=[^\W\d_])|(?<![^\W_])\?(?=[^\W\d_A-Z])")
#: How many times as frequent a word has to be as the garbled form it is put for, where the bytes alone don't tell.
MORE_FREQUENT = 3
#: The same word in at least so many rows: for letters read in another code page, for question marks.
LEAST_COUNT, LEAST_COUNT_MARK = 2, 3
#: Cost of leaving the text as it is read (nats), against that of a control character in it.
_LEAVE, _CONTROL = 3.0, 8.0

#: Code pages by which UTF-8 bytes were read, and pairs (bytes written in, bytes read in) of single-byte code pages.
READ_AS = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1251", "cp1250", "koi8_r")
CONFUSED = tuple((w, r) for w, r in (
    ("cp1252", "cp1251"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "cp1250"), ("cp1252", "koi8_r"),
    ("cp850", "latin-1"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "latin-1"), ("mac_roman", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"),
))


@lru_cache(maxsize=32)
def _bytes_of(page: str) -> dict[str, int]:
    """Byte by character of a code page; bytes it leaves open count as the control character of that number."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


@lru_cache(maxsize=32)
def _swap(written: str, read: str) -> dict[int, str]:
    """Character as read -> character as written."""
    out = {}
    for c, b in _bytes_of(read).items():
        try:
            out[ord(c)] = bytes([b]).decode(written)
        except UnicodeDecodeError:
            continue
    return out


def suspects(text: str) -> list[str]:
    """Tokens of ``text`` worth a lattice, in order: with characters beyond ASCII, or a question mark inside or before a word."""
    if text.isascii() and "?" not in text:
        return []
    if "«" in text or "»" in text:
        tokens = _TOKEN.findall(text)
    else:
        tokens = [t.decode() for t in text.encode().split() if not t.isascii() or b"?" in t]
    return [t for t in tokens if not t.isascii() or _MARKED.search(t)]


class Channel:
    """Costs of characters beyond ASCII, from how often the corpus has them, and the edges of the byte lattice."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {c: -math.log((n + 0.5) / total) for c, n in counts.items()}
        self.unseen = -math.log(0.1 / total)

    def of(self, c: str) -> float:
        return self.cost.get(c, self.unseen) if c > "\x7f" else 0.0

    def as_read(self, c: str) -> float:
        return self.of(c) + (_CONTROL if "\x80" <= c <= "\x9f" else 0.0)

    def utf8_edges(self, token: str, i: int) -> Iterator[tuple[int, str]]:
        """``(end, character)`` of each UTF-8 character whose bytes some code page reads as the characters from ``i`` on."""
        for page in READ_AS:
            byte = _bytes_of(page)
            lead = byte.get(token[i], 0)
            size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
            if not size or i + size > len(token):
                continue
            try:
                x = bytes([lead, *(byte[d] for d in token[i + 1 : i + size])]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if x in self.cost or (size > 2 and unicodedata.category(x)[0] in "LSP"):
                yield i + size, x

    def cut_edges(self, token: str, i: int) -> Iterator[tuple[int, int]]:
        """``(end, lead byte)`` of a UTF-8 character of two bytes whose second one is lost."""
        if token[i + 1 : i + 2] == LOST:
            for page in READ_AS:
                if 0xC2 <= (lead := _bytes_of(page).get(token[i], 0)) <= 0xDF:
                    yield i + 2, lead

    def decode_utf8(self, token: str) -> str:
        """``token`` without one round of UTF-8 read in a code page: the cheapest path by the costs of characters alone."""
        n = len(token)
        best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(math.inf, 0, "")] * n
        for i, c in enumerate(token):
            base = best[i][0]
            if base + self.as_read(c) < best[i + 1][0]:
                best[i + 1] = (base + self.as_read(c), i, c)
            if c < "\x80":
                continue
            for end, x in self.utf8_edges(token, i):
                if base + self.of(x) + _LEAVE < best[end][0]:
                    best[end] = (base + self.of(x) + _LEAVE, i, x)
        out, i = [], n
        while i:
            _, i, x = best[i]
            out.append(x)
        return "".join(reversed(out))

    def rounds(self, token: str) -> list[str]:
        """The token, and what each round of decoding leaves of it, until nothing changes; every round makes it shorter."""
        out = [token]
        while (x := self.decode_utf8(out[-1])) != out[-1]:
            out.append(x)
        return out


def readings(token: str) -> Iterator[tuple[str, str]]:
    """``(channel, restored)`` for each pair of single-byte code pages that can have been confused."""
    beyond = [c for c in token if c > "\x7f" and c != LOST]
    if beyond:
        for written, read in CONFUSED:
            table = _swap(written, read)
            if all(ord(c) in table or c not in _bytes_of(read) for c in beyond) and (x := token.translate(table)) != token:
                yield f"{written} as {read}", x


def gap_key(word: str) -> str | None:
    """A word with each run beyond ASCII as one gap; None with fewer than two ASCII letters. Whatever was lost or misread of it, the key stays."""
    key = regex.sub(r"[^\x00-\x7f]+", LOST, word)
    return key if sum(map(str.isalpha, key)) >= 2 and LOST in key else None


def words_of(text: str) -> list[str]:
    """Words in lower case that have characters beyond ASCII."""
    return [w for x in _WORD.findall(text) if not (w := x.lower()).isascii()]


def asked_words(token: str, channel: Channel) -> tuple[list[str], list[str]]:
    """Keys under which words are looked up that paths through the token's lattice may spell, and those of the words as they stand."""
    own = [w for w in words_of(token) if LOST not in w]
    spelled = [w for r in (*channel.rounds(token)[1:], *(x for _, x in readings(token)), token, _LOSSY.sub(LOST, token)) for w in words_of(r)]
    keys = dict.fromkeys(w for w in spelled if LOST not in w and len(w) >= 3)
    keys |= dict.fromkeys(k for w in spelled if LOST in w for v in (w, w.strip(LOST)) if len(w) >= 3 and (k := gap_key(v)))
    return [k for k in keys if k not in own], own


class Lattice:
    """The byte lattice of one token, searched together with a trie of the corpus words that its paths may spell."""

    def __init__(self, token: str, channel: Channel, words: dict[str, tuple[str, int]], total: int):
        self.token, self.channel, self.words, self.total = token, channel, words, max(2, total)
        self.trie: dict = {}
        for w, (_, n) in words.items():
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node[""] = n

    def _edges(self, i: int, name: str, table: dict[int, str], marks: frozenset[int]) -> Iterator[tuple[int, str, float]]:
        """``(end, character, cost)`` from position ``i`` in one channel; the character U+FFFD is a wildcard."""
        c, channel = self.token[i], self.channel
        if c == LOST:
            end = i + 1
            while end <= min(len(self.token), i + 3) and self.token[end - 1] == LOST:
                yield end, LOST, 0.0
                end += 1
            return
        if i in marks:
            yield i + 1, LOST, 0.0
            return
        if (x := table.get(ord(c)) if c > "\x7f" else None) is not None:
            yield i + 1, x, 0.0
            return
        yield i + 1, c, channel.as_read(c) if name == "utf-8" else 0.0
        if name == "utf-8" and c > "\x7f":
            for end, x in channel.utf8_edges(self.token, i):
                yield end, x, channel.of(x) + _LEAVE
            for end, lead in channel.cut_edges(self.token, i):
                yield end, LOST + chr(lead), _LEAVE

    def best(self, name: str, table: dict[int, str] | None = None, marks: frozenset[int] = frozenset()) -> tuple[float, list[tuple[str, str]], int, bool] | None:
        """The cheapest path of a channel: ``cost``, ``(character, as found)`` along it, least count of its words, whether all are known.

        Viterbi search; a state is a position, the trie node of the word so far
        (None: no corpus word begins so) and whether the word has characters
        beyond ASCII. A word costs its log frequency in the corpus when it ends.
        With a code page table or marks a changed word must be one of the corpus.
        """
        strict = table is not None or bool(marks)
        states: list[dict] = [{} for _ in range(len(self.token) + 1)]
        states[0][id(self.trie), False] = (0.0, self.trie, None, "", "", math.inf, True)
        unknown = math.log(2.0 * self.total)

        def close(node: dict | None, beyond: bool) -> tuple[float, float, bool]:
            if not beyond:
                return 0.0, math.inf, True
            n = node.get("", 0) if node is not None else 0
            return (math.log(self.total / n), n, True) if n else (math.inf if strict else unknown, 0, False)

        for i in range(len(self.token)):
            for at, s in sorted(states[i].items(), key=lambda x: x[1][0]):
                cost, node, _, _, _, least, known = s
                for end, x, step in self._edges(i, name, table or {}, marks):
                    if x[0] == LOST:
                        lead = ord(x[1]) if len(x) > 1 else 0
                        options = [(c, child) for c, child in (node or {}).items() if c > "\x7f" and (not lead or c.encode()[0] == lead)]
                        if not strict:
                            options.append((LOST, None))
                        moves = [(c, child, True) for c, child in options]
                    else:
                        low = x.lower()
                        letter = x.isalpha() or "\u0300" <= x <= "\u036f" or (x in "’'" and i > 0 and self.token[i - 1].isalpha() and self.token[i + 1 : i + 2].isalpha())
                        moves = [(x, node.get(low) if node is not None else None, x > "\x7f" and letter)] if letter else [(x, False, False)]
                    for c, child, beyond in moves:
                        if child is False:  # no letter: the word ends before it
                            extra, n, ok = close(node, at[1])
                            new = (cost + step + extra, self.trie, (i, at), c, x[0], min(least, n), known and ok)
                            key = (id(self.trie), False)
                        else:
                            new = (cost + step, child, (i, at), c, x[0], least, known)
                            key = (id(child), at[1] or beyond)
                        if new[0] < math.inf and (key not in states[end] or new[0] < states[end][key][0]):
                            states[end][key] = new
        last = []
        for at, s in states[-1].items():
            extra, n, ok = close(s[1], at[1])
            last.append((s[0] + extra, at, min(s[5], n), s[6] and ok))
        cost, at, least, known = min(last, key=lambda x: x[0], default=(math.inf, None, 0, False))
        if cost == math.inf:
            return None
        path, i = [], len(self.token)
        while i:
            s = states[i][at]
            path.append((s[3], s[4]))
            i, at = s[2]
        return cost, path[::-1], 0 if least == math.inf else int(least), known and least < math.inf

    def cased(self, path: list[tuple[str, str]]) -> str:
        """The path's text; letters filled in for lost ones take the case their word has in the corpus, or that of an upper-case word."""
        out = [c for c, _ in path]
        if not any(x == LOST and c != LOST for c, x in path):
            return "".join(out)
        for m in _WORD.finditer("".join(out)):
            shown = self.words.get(m.group().lower(), (m.group(), 0))[0]
            read = [path[k][0] for k in range(m.start(), m.end()) if path[k][1] != LOST]
            upper = len(read) > 1 and all(c.isupper() for c in read if c.isalpha())
            for k in range(m.start(), m.end()):
                if path[k][1] == LOST and out[k] != LOST and len(shown) == m.end() - m.start():
                    out[k] = shown[k - m.start()].upper() if upper else shown[k - m.start()]
        return "".join(out)


def restore(token: str, n: int, words: dict[str, tuple[str, int]], own: dict[str, int], channel: Channel, total: int) -> tuple[str, str, str] | None:
    """``(restored, with gaps, channel)`` of a token that is garbled; None for one that is not.

    ``n``: in how many places of different texts the token stands, ``own`` the
    same of its words as they are, ``words`` the corpus words that its lattice
    may spell. UTF-8 read in a code page is known by its bytes and the
    characters' frequencies, U+FFFD by itself. Another code page or a question
    mark takes words of the corpus that are ``MORE_FREQUENT`` as often.
    """
    total = max(2, total)
    rounds = channel.rounds(token)
    last = rounds[-1]
    if len(rounds) > 1:
        found = Lattice(rounds[-2], channel, words, total).best("utf-8")
        if found and (text := Lattice(rounds[-2], channel, words, total).cased(found[1])) != rounds[-2]:
            return text, "".join(LOST if x == LOST else c for c, x in found[1]), "utf-8"
        return last, last, "utf-8"
    lattice = Lattice(token, channel, words, total)
    if LOST in token:
        _, path, _, known = lattice.best("utf-8")
        return lattice.cased(path) if known or LOST not in "".join(c for c, _ in path) else token, token, "lost"
    stands = sum(math.log(total / max(0.5, own[w])) for w in own) if own else math.log(total / max(1, n))
    taken = []
    control = any("\x80" <= c <= "\x9f" and c != "\x85" for c in token)  # 85 is a line end
    asked = [(name, _swap(*name.split(" as ")), frozenset(), LEAST_COUNT) for name, _ in readings(token)]
    if marks := frozenset(m.start() for m in _LOSSY.finditer(token)):
        asked.append(("question mark", None, marks, LEAST_COUNT_MARK))
    for name, table, marked, least in asked:
        if (found := lattice.best(name, table, marked)) and found[3] and found[2] >= least and (control or found[0] + math.log(MORE_FREQUENT) <= stands + 1e-9):
            gaps = "".join(LOST if x == LOST else c for c, x in found[1])
            taken.append((found[0], len(found[1]), lattice.cased(found[1]), gaps, name))
    if taken:
        _, _, text, gaps, name = min(taken)
        return text, gaps, name
    return (token, token, "control") if control else None


_CORE = re.compile(r"[^\W_]|[\ufffd\x80-\x9f]")
_OPEN, _CLOSE = set("\"'“„«‘‚‹"), set("\"'”“»’›")

def is_quoted(token: str, restored: str) -> bool:
    """Whether the token only shows a garbled character: one character alone between quotation marks that are sound themselves."""
    core = restored.strip(".,;:!?)(…")
    if len(core) >= 3 and core[0] in _OPEN and core[-1] in _CLOSE and core[0] in token and core[-1] in token:
        inner = core[1:-1].strip(" \t\u00a0\u202f")
        return len(inner) <= 2 and not (len(inner) == 2 and inner.isascii())
    return False


def _letters_alone(token: str, restored: str) -> bool:
    """Whether the token is one garbled letter, with nothing but sound marks around it."""
    core = _CORE.findall(restored)
    return len(core) == 1 and core[0] != LOST and all(c in token for c in restored if not _CORE.match(c))


def suspect_tokens(documents: DataFrame) -> DataFrame:
    """``row, doc_id, h, tokens``: the suspect tokens of each text that has any, and the hash of the whole text (SHA-256); written once.

    ``row`` numbers the rows, whatever their ``doc_id``. Only these tokens leave the scan, never whole texts.
    """
    src = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, hashes, tokens = [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                if found := suspects(text):
                    at.append(i)
                    hashes.append(hashlib.sha256(text.encode()).digest())
                    tokens.append(found)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(hashes, pa.binary()), pa.array(tokens, pa.list_(pa.string()))], names=["row", "doc_id", "h", "tokens"])

    return cut(src.mapInArrow(run, "row bigint, doc_id bigint, h binary, tokens array<string>"))


def _vocabulary(tokens: DataFrame) -> DataFrame:
    """Corpus words beyond ASCII: ``key, own, word, n, n_rows``, by the word in lower case and by its gap key; every word, however rare."""
    words = tokens.select("n", "n_rows", F.explode(F.regexp_extract_all("token", F.lit(r"((?:[\p{L}\p{M}]+(?:[’'][\p{L}\p{M}]+)*))"), 1)).alias("word")).where(r"word rlike '[^\\x00-\\x7f]'")
    forms = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))
    low = forms.groupBy(F.lower("word").alias("own")).agg(F.max_by("word", F.struct("n", "n_rows", "word")).alias("word"), F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))
    gap = F.regexp_replace("own", r"[^\x00-\x7f]+", LOST)
    return low.select(F.explode(F.array(F.col("own"), gap)).alias("key"), "own", "word", "n", "n_rows").where(F.col("key") != LOST)


def repairs(held: DataFrame) -> DataFrame:
    """Garbled tokens of the corpus: ``token, restored, channel, sure, quoted`` (``sure``: whether it shows by itself that its document is garbled).

    Every different token is decoded once, by Viterbi search over its byte
    lattice and the corpus words that paths through it may spell. Those words
    are found by joins on the word or, for lost bytes, on the word with gaps, so
    no vocabulary is broadcast and none is cut off. What may be garbled is
    counted once per distinct text, so that a garbled document stays one however
    often it was copied, and what vouches for a candidate in every row. Only the
    counts of characters (bounded by the number of Unicode characters) leave the
    executors.
    """
    spark = held.sparkSession
    texts = held.groupBy("h").agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("copies"))
    tokens = cut(texts.select(F.explode("tokens").alias("token"), "copies").groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("n_rows")))
    chars = tokens.select("n_rows", F.explode(F.split(F.regexp_replace("token", r"[\x00-\x7f]+", ""), "")).alias("c")).where("c <> ''").groupBy("c").agg(F.sum("n_rows").alias("n"))
    counts = spark.sparkContext.broadcast({r.c: r.n for r in chars.toLocalIterator()})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(counts.value)
        for b in batches:
            rows = []
            for i, t in enumerate(b.column(0).to_pylist()):
                keys, own = asked_words(t, channel)
                plain = LOST in t or any("\x80" <= c <= "\x9f" for c in t) or channel.decode_utf8(t) != t
                if keys or plain:
                    rows.append((i, keys, own, plain))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            take = pa.array(cols[0], pa.int64())
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(cols[1], texts), pa.array(cols[2], texts), pa.array(cols[3], pa.bool_())], names=["token", "n", "keys", "own", "plain"])

    asked = cut(tokens.select("token", "n").mapInArrow(ask, "token string, n bigint, keys array<string>, own array<string>, plain boolean"))
    vocabulary = cut(_vocabulary(tokens))
    total = vocabulary.where("key = own").agg(F.sum("n_rows")).first()[0] or 0
    # a word spelled by a path, or standing there as it is; the latter alone is no reason to search
    lookups = asked.select("token", F.explode(F.concat(F.transform("keys", lambda k: F.struct(k.alias("key"), F.lit(True).alias("spelled"))), F.transform("own", lambda k: F.struct(k.alias("key"), F.lit(False).alias("spelled"))))).alias("k"))
    met = lookups.select("token", "k.*").join(vocabulary, "key")
    met = met.groupBy("token").agg(F.collect_list(F.struct("spelled", "own", "word", "n", "n_rows")).alias("met"), F.bool_or("spelled").alias("any"))
    source = asked.select("token", "n", "plain").join(met, "token", "left").where("plain or any").select("token", "n", "met")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(counts.value)
        for b in batches:
            rows = []
            for t, n, met in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                words = {m["own"]: (m["word"], m["n_rows"]) for m in met or ()}
                own = {m["own"]: m["n"] for m in met or () if not m["spelled"]}
                if found := restore(t, n, words, own, channel, total):
                    restored, gaps, name = found
                    quoted = is_quoted(t, gaps)
                    rows.append((t, restored, name, not quoted and (not _letters_alone(t, gaps) or LOST in gaps), quoted))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["token", "restored", "channel", "sure", "quoted"])

    return source.mapInArrow(run, "token string, restored string, channel string, sure boolean, quoted boolean")


def _garbled(documents: DataFrame) -> DataFrame:
    """``row, doc_id, fixes, channels`` of the garbled documents; texts are not shuffled, only suspect tokens are."""
    held = suspect_tokens(documents)
    hits = salted_join(held.select("row", "doc_id", F.explode(F.array_distinct("tokens")).alias("token")), repairs(held), ["token"])
    per = hits.groupBy("row", "doc_id").agg(
        F.collect_list(F.when(~F.col("quoted"), F.struct("token", "restored"))).alias("fixes"),
        F.bool_or("sure").alias("sure"), F.array_sort(F.collect_set(F.when(F.col("sure"), F.col("channel")))).alias("channels"),
    )
    return per.where("sure").drop("sure")


def garbled_ids(documents: DataFrame) -> DataFrame:
    """``doc_id`` of every document with garbled text; as ``garbled_documents``, but texts are read once and never shuffled."""
    return _garbled(documents).select("doc_id")


def garbled_documents(documents: DataFrame) -> DataFrame:
    """Documents with garbled text: ``doc_id, text`` (restored where possible), ``n_places, n_open`` (places with letters still lost), ``channels``.

    Null, empty and clean texts give no rows; so do texts that only quote
    garbled characters. Copies of a document are cases each, as are repeated
    rows. An empty table gives no rows. Tokens meet their repairs, and texts
    theirs, by joins whose smaller side is measured: broadcast below a bound,
    salted beyond it.
    """
    per = _garbled(documents).groupBy("doc_id").agg(F.first("fixes").alias("fixes"), F.first("channels").alias("channels"))
    src = salted_join(documents.select("doc_id", F.col("text").cast("string").alias("text")), per, ["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, places, open_ = [], [], []
            for text, fixes in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                known = {f["token"]: f["restored"] for f in fixes}
                hit = [0, 0]

                def put(m: re.Match, known: dict = known, hit: list = hit) -> str:
                    new = known.get(m.group())
                    if new is None:
                        return m.group()
                    hit[0] += 1
                    hit[1] += LOST in new
                    return new

                texts.append(_TOKEN.sub(put, text))
                places.append(hit[0])
                open_.append(hit[1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(places, pa.int32()), pa.array(open_, pa.int32()), b.column(3)], names=["doc_id", "text", "n_places", "n_open", "channels"])

    return src.select("doc_id", "text", "fixes", "channels").mapInArrow(run, "doc_id bigint, text string, n_places int, n_open int, channels array<string>")
