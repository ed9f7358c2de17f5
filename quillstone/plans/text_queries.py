"""Queries of the text functions and the segmentation, with their SQL."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import text as t
from quillstone.operators import noise, segmentation
from quillstone.plans.volumes import VOLUME, volume_chunks
from quillstone.runtime import table
from quillstone.sources import readers

#: SQL of the tokens, white space and words of ``functions.text``.
TOK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\x{9}-\x{D}\x{1C}-\x{1F}\x{85}]"
SP = r"[\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]"
NSP = r"[^\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]+"


def _tokens(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{TOK}'))"


def _squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SP}+', ' ', 'g'))"


def _strip(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^{SP}+', ''), '{SP}+$', '')"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null")


def documents_by_language(spark: SparkSession, d: str) -> DataFrame:
    """Documents, tokens, sentences and documents over 400 tokens by language."""
    n = t.token_count(F.col("text"))
    per = _documents(spark, d).select("lang", n.alias("tokens"), F.size(t.sentences(F.col("text"))).alias("sentences"))
    return per.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"), F.sum("sentences").alias("sentences"), F.count_if(F.col("tokens") > 400).alias("oversized"))


def text_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Tokens, words and estimates of each document."""
    c = F.col("text")
    return _documents(spark, d).select("doc_id", t.token_count(c).alias("tokens"), t.word_count(c).alias("words"), t.tokens_by_words(c).alias("by_words"), t.tokens_by_chars(c).alias("by_chars"))


def text_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Squeezed, as generated, without thinking, as a file name."""
    c = F.col("text")
    return _documents(spark, d).select("doc_id", t.squeeze(c).alias("squeezed"), t.generated(c).alias("generated"), t.without_thinking(c).alias("unthought"), t.sanitize_name(F.col("title")).alias("name"))


def tagged_text(spark: SparkSession, d: str) -> DataFrame:
    """Tags around titles and languages, taken out again; plain text where there is no tag; yes and no in texts that say so."""
    lang = F.coalesce("lang", F.lit("xx"))
    x = F.concat(F.lit("<think>not "), lang, F.lit("</think><question> "), F.coalesce("title", F.lit("none")), F.lit("\n?</question> yes <q score=\"2.5\">A</q><q> B </q>"))
    plain = F.concat(F.lit("<think>a</think>\n \""), lang, F.lit("  x\"</summary>"))
    said = F.when(F.col("doc_id") % 5 == 0, F.lit("<think>no</think>")).when(F.col("doc_id") % 5 == 1, F.lit("It is FALSE.")).when(F.col("doc_id") % 5 == 2, F.lit("true or false")).when(F.col("doc_id") % 5 == 3, F.lit("No, yes")).otherwise(F.lit(None))
    return _documents(spark, d).select(
        "doc_id", t.tag(x, "question").alias("question"), t.tag(x, "summary").alias("summary"), t.tag_or_text(x, "question").alias("tagged"), t.tag_or_text(plain, "summary").alias("plain"),
        F.size(t.scored_questions(x)).alias("n_scored"), t.scored_questions(x)[0]["score"].alias("first_score"), t.yes_no(said).alias("said"),
        t.yes_no(x).alias("yes_word"), t.yes_no(F.concat(F.lit("know "), lang, F.lit(" yes")), False).alias("yes_inside"),
    )


def sentence_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of each document and its extractive summary."""
    return _documents(spark, d).select("doc_id", F.size(t.sentences(F.col("text"))).alias("sentences"), t.extractive_summary(F.col("text")).alias("summary"))


def page_text(spark: SparkSession, d: str) -> DataFrame:
    """X11: cleaned text of stage-1 chunks, by length and hash."""
    c = t.clean_page(F.col("output"))
    return table(spark, d, "source_chunks").where("output is not null").select("chunk_row", F.length(c).alias("n_chars"), F.sha1(c).alias("hash"))


def headings(spark: SparkSession, d: str) -> DataFrame:
    """Heading and front matter tests of stage-1 chunks."""
    c = F.col("output")
    return table(spark, d, "source_chunks").where("output is not null").select("chunk_row", noise.looks_like_heading(c).alias("is_heading"), noise.front_matter_score(c).alias("front_matter"))


def fixed_token_windows(spark: SparkSession, d: str) -> DataFrame:
    """Number and first window of 64 tokens."""
    w = t.tokens(F.col("text"))
    return _documents(spark, d).where(t.token_count(F.col("text")) > 0).select("doc_id", F.ceil(F.size(w) / 64).cast("bigint").alias("n_windows"), F.array_join(F.slice(w, 1, 64), " ").alias("first_window"))


def all_token_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every window of 64 tokens of whole texts, the last one maybe shorter."""
    w = _documents(spark, d).select("doc_id", F.posexplode(segmentation.fixed_tokens(F.col("text"), 64)).alias("pos", "window"))
    return w.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("window_no"), "window")


def paragraph_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of more than 30 characters."""
    p = _documents(spark, d).select("doc_id", F.posexplode(segmentation.paragraphs(F.regexp_replace("text", "\r\n?", "\n"))).alias("pos", "paragraph"))
    return p.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "paragraph")


def greedy_chunk_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of each volume packed into blocks of at most 4 chunks and 600 tokens."""
    return segmentation.greedy_blocks(volume_chunks(spark, d), VOLUME, "chunk_index", "output", 600, 4)


def merged_small_parts(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs merged as long as they stay below 80 tokens."""
    return segmentation.explode_pieces(_documents(spark, d), "doc_id", "text", lambda x: segmentation.merge_small(segmentation.paragraph_list(x), 80))


def overlapping_word_chunks(spark: SparkSession, d: str) -> DataFrame:
    """G1: overlapping chunks of documents."""
    return segmentation.explode_pieces(_documents(spark, d), "doc_id", "text", segmentation.overlapping_chunks)


def prechunked(spark: SparkSession, d: str) -> DataFrame:
    """G4."""
    return segmentation.explode_pieces(_documents(spark, d), "doc_id", "text", lambda x: segmentation.smart_prechunk(x, 200))


def capped_pieces(spark: SparkSession, d: str) -> DataFrame:
    """G7."""
    return segmentation.explode_pieces(_documents(spark, d), "doc_id", "text", lambda x: segmentation.split_single(x, 200))


def word_boundary_pieces(spark: SparkSession, d: str) -> DataFrame:
    """G15."""
    return segmentation.explode_pieces(_documents(spark, d), "doc_id", "text", lambda x: segmentation.word_boundary_chunks(x, 128))


def adaptive_windows(spark: SparkSession, d: str) -> DataFrame:
    """The window from the first chunk of each volume."""
    w = segmentation.adaptive_window(volume_chunks(spark, d), VOLUME, "chunk_index", "output", F.lit(1), 3, 12, 900, 1500)
    return w.select(*VOLUME, "chunk_index", "n_tokens", "used")


def segmented_files(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of each volume, a boundary function choosing two thirds of every window, rounded up."""
    cut = lambda sizes: segmentation.segment(sizes, 8, 900, lambda first, after: -(-2 * (after - first) // 3))
    return segmentation.blocks(volume_chunks(spark, d), VOLUME, "chunk_index", "output", cut)


def line_frequencies(spark: SparkSession, d: str) -> DataFrame:
    """A3: lines on at least three pages of their book."""
    return noise.line_frequency(table(spark, d, "source_chunks").where("output is not null"), "source_file", "chunk_row", "output").where("n_pages >= 3")


def noise_lines(spark: SparkSession, d: str) -> DataFrame:
    """Repeated page furniture."""
    pages = table(spark, d, "source_chunks").where("output is not null")
    return noise.repeated_noise(noise.line_frequency(pages, "source_file", "chunk_row", "output"), pages, "source_file", "chunk_row")


def pages_without_noise(spark: SparkSession, d: str) -> DataFrame:
    """Chunks without their book's page furniture, by length."""
    pages = table(spark, d, "source_chunks").where("output is not null")
    clean = noise.without_noise(pages, noise_lines(spark, d), "source_file", "chunk_row", "output")
    return clean.select("source_file", "chunk_row", F.length("text").alias("n_chars"))


def names_and_sizes(spark: SparkSession, d: str) -> DataFrame:
    """X13, X14, X16-X18, X20, X23-X26 over values made of part names."""
    p = table(spark, d, "part")
    n = F.concat(F.lit("org/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), "p_size", F.lit("B-a3B-GGUF"))
    return p.select(
        "p_partkey", t.parameters_from_name(n).alias("parameters"), t.expert_size(n).alias("active"), t.base_name(n).alias("base"),
        t.layer_of(F.concat(F.lit("blk."), "p_size", F.lit(".attn"))).alias("layer"), t.bytes_of_size(F.concat("p_size", F.lit("M"))).alias("bytes"),
        t.boundary_index(F.concat(F.lit("<think>3</think> Answer: "), "p_size"), F.lit(40)).alias("boundary"), t.last_int(F.concat(F.lit("in 7, at "), "p_size"), 1, 30).alias("last"),
        t.perplexity(F.concat(F.lit("[1] 9.5, [2] "), "p_size", F.lit(".25"))).alias("perplexity"), t.api_base(F.concat(F.lit("http://h/"), "p_size", F.lit("/chat/completions/"))).alias("api"),
        t.json_object(F.concat(F.lit("x {\"a\":"), "p_size", F.lit("} y"))).alias("json"), t.json_with(F.concat(F.lit("{\"a\":\""), "p_size", F.lit("\"}")), ["a"], {"a": ["7", "9"]}).alias("chosen"),
        t.parameters_anywhere(n).alias("anywhere"), t.billions_from_name(n).alias("billions"), t.quantization_of(F.concat("p_name", F.when(F.col("p_size") > 25, F.lit("-Q4_K.gguf")).otherwise(F.lit(".imatrix"))), ["Q8_0", "Q4_K"]).alias("quantization"), F.array_join(t.file_candidates(n), "|").alias("files"),
    )


def heading_questions(spark: SparkSession, d: str) -> DataFrame:
    """Heading lines of documents and the question made of them."""
    return _documents(spark, d).select("doc_id", F.array_join(t.heading_lines(F.col("text")), "|").alias("headings"), t.fallback_question(F.col("text")).alias("question"))


def conversations(spark: SparkSession, d: str) -> DataFrame:
    """Question-answer documents as one line each."""
    turns = _documents(spark, d).where("doc_type = 'qa_record'").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?m)^(user|assistant): "), 1)).alias("turn", "role"), F.split("text", r"(?m)^(?:user|assistant): ").alias("parts"))
    return segmentation.chat_lines(turns.select("doc_id", "turn", "role", F.col("parts")[F.col("turn") + 1].alias("content")), "doc_id", "turn")


def book_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections from every page on which a chunk names its title, by length; pages are the chunks' start pages."""
    c = table(spark, d, "source_chunks").where("start_page is not null and source_file is not null")
    pages = c.groupBy("source_file", F.col("start_page").alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_row", "output"))), lambda x: x["output"]), "\n\n").alias("text"))
    named = c.where("source_title is not null").select("source_file", F.col("start_page").alias("page"), F.col("source_title").alias("title"), F.col("chunk_row").alias("position"))
    s = segmentation.sections(pages, named, "source_file")
    return s.select("source_file", "title", "start_page", "end_page", F.length("text").alias("n_chars"))


def outline_sections(spark: SparkSession, d: str) -> DataFrame:
    """Each book's outline of titles, one level for each volume and its chunks below, flattened to page spans."""
    c = volume_chunks(spark, d)
    e = c.select("source_file", F.array("volume", F.col("chunk_index").cast("bigint")).alias("path"), F.coalesce("source_title", F.lit("Document")).alias("title"), F.col("start_page").alias("page"), "end_page")
    last = e.groupBy("source_file").agg(F.max("end_page").alias("last"))
    return readers.outline(e.drop("end_page").join(last, "source_file"), "source_file", "last")


def page_line_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines of stage-1 pages, and how many are blank."""
    lines = readers.page_lines(table(spark, d, "source_chunks"), "source_file", "chunk_row", "output")
    return lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.btrim("line") == "").alias("n_blank"), F.max("line_no").alias("last"))


def word_counts_checked(spark: SparkSession, d: str) -> DataFrame:
    """Stage-1 chunks whose stored number of words is not that of their text."""
    n = t.word_count(F.col("output"))
    return table(spark, d, "source_chunks").where("output is not null").select("chunk_row", "word_count", n.alias("words")).where("word_count is null or word_count <> words")


def document_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Each document's position within its source by time, times unknown first."""
    w = Window.partitionBy("source").orderBy(F.asc_nulls_first("added_at"), "doc_id")
    return table(spark, d, "documents").select("doc_id", "source", F.row_number().over(w).alias("position"))


_NORMAL_LINES = f"SELECT source_file, chunk_row, i, line, lower({_squeeze('line')}) AS k FROM (SELECT source_file, chunk_row, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS i FROM source_chunks WHERE output IS NOT NULL)"
_NOISE = rf"""l AS ({_NORMAL_LINES}), b AS (SELECT source_file, count(DISTINCT chunk_row) AS n_all FROM source_chunks WHERE output IS NOT NULL GROUP BY 1),
        f AS (SELECT source_file, k AS line, count(DISTINCT chunk_row) AS n_pages FROM l WHERE k <> '' GROUP BY ALL),
        z AS (SELECT source_file, line, n_pages FROM f JOIN b USING (source_file) WHERE length(line) <= 90 AND n_pages >= greatest(4, n_all // 4)
              AND (regexp_matches(line, '(?i)\bpage\b|\d+\s*/\s*\d+|copyright|all rights reserved') OR length(regexp_replace(line, '[^A-Za-z]', '', 'g')) < 5))"""

_JOINED = r"regexp_replace(regexp_replace(output, '\r\n?', chr(10), 'g'), '([A-Za-z])-\n([A-Za-z])', '\1\2', 'g')"
_UNWRAPPED = rf"regexp_replace(regexp_replace({_JOINED}, '([^\n])\n([^\n])', '\1 \2', 'g'), '([^\n])\n([^\n])', '\1 \2', 'g')"

_SIZED = f"""o AS (SELECT source_file, chunk_total, chunk_row - chunk_index AS volume, chunk_index, {_tokens("coalesce(output, '')")} AS n, row_number() OVER (PARTITION BY source_file, chunk_total, chunk_row - chunk_index ORDER BY chunk_index) AS r FROM source_chunks WHERE source_file IS NOT NULL)"""

_HEADED = r"(?mi)^((?:chapter|part|section|kapitel|capítulo|chapitre)\s+[\p{L}\p{N}_]+|\d+(?:\.\d+)*\.?\s+\S|#{1,6}\s)"
_MARKED = "text"
for _ in range(3):
    _MARKED = f"regexp_replace({_MARKED}, '{_HEADED}', chr(30) || '\\1', 'g')"

SQL = {
    "page_text": rf"""WITH c AS (SELECT chunk_row, trim(regexp_replace(regexp_replace({_UNWRAPPED}, '\n{{3,}}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM source_chunks WHERE output IS NOT NULL)
        SELECT chunk_row, length(t)::INT AS n_chars, sha1(t) AS hash FROM c""",
    "noise_lines": f"WITH {_NOISE} SELECT * FROM z",
    "pages_without_noise": f"""WITH {_NOISE}, g AS (SELECT l.source_file, chunk_row, string_agg(l.line, chr(10) ORDER BY i) FILTER (z.line IS NULL) AS t FROM l LEFT JOIN z ON z.source_file = l.source_file AND z.line = l.k GROUP BY 1, 2)
        SELECT source_file, chunk_row, coalesce(length(t), 0)::INT AS n_chars FROM g""",
    # parts in order with their tokens; a part is put behind the ones before while together they have fewer than 80
    "merged_small_parts": rf"""WITH RECURSIVE p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g'), '\n\s*\n'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: length(x) > 0) AS l FROM documents WHERE text IS NOT NULL),
        e AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS part FROM p), n AS (SELECT *, {_tokens("part")} AS n FROM e),
        f AS (SELECT doc_id, i, part, n AS used, 1 AS piece_no FROM n WHERE i = 1 UNION ALL
              SELECT n.doc_id, n.i, n.part, CASE WHEN f.used + n.n < 80 THEN f.used + n.n ELSE n.n END, CASE WHEN f.used + n.n < 80 THEN piece_no ELSE piece_no + 1 END FROM f JOIN n ON n.doc_id = f.doc_id AND n.i = f.i + 1)
        SELECT doc_id, piece_no::INT AS piece_no, string_agg(part, chr(10) || chr(10) ORDER BY i) AS piece FROM f GROUP BY doc_id, piece_no""",
    "documents_by_language": rf"""WITH p AS (SELECT lang, {_tokens('text')} AS tokens, len(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31))) AS sentences FROM documents WHERE text IS NOT NULL)
        SELECT lang, count(*) AS docs, sum(tokens)::BIGINT AS tokens, sum(sentences)::BIGINT AS sentences, count(*) FILTER (tokens > 400) AS oversized FROM p GROUP BY lang""",
    "text_sizes": rf"""WITH p AS (SELECT doc_id, text, {_tokens('text')} AS tokens, len(regexp_extract_all(text, '{NSP}')) AS words FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, tokens::INT AS tokens, words::INT AS words, floor(words * 0.75)::INT AS by_words, greatest(1, floor(length(text) / 4))::INT AS by_chars FROM p""",
    "text_normalised": rf"""SELECT doc_id, {_squeeze('text')} AS squeezed, trim({_squeeze('text')}, ' "''') AS generated, trim(regexp_replace(text, '(?is)<think>.*?(?:</think>|\z)', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS unthought,
        regexp_replace(replace(title, ' ', '_'), '[^\p{{L}}\p{{N}}_.\-]', '', 'g') AS name FROM documents WHERE text IS NOT NULL""",
    "tagged_text": rf"""WITH q AS (SELECT doc_id, lang, {_squeeze("coalesce(title, 'none') || chr(10) || '?'")} AS question FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, question, NULL::VARCHAR AS summary, trim(question, ' "' || chr(39)) AS tagged, coalesce(lang, 'xx') || ' x' AS plain, 2::INT AS n_scored, 2.5::DOUBLE AS first_score, doc_id % 5 IN (0, 2, 4) AS said, TRUE AS yes_word, FALSE AS yes_inside FROM q""",
    "sentence_counts": rf"""WITH p AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)) AS s, string_split(regexp_replace({_squeeze('text')}, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)) AS q FROM documents WHERE text IS NOT NULL),
        f AS (SELECT doc_id, len(s)::INT AS sentences, array_to_string(q[1:2], ' ') AS x FROM p) SELECT doc_id, sentences, CASE WHEN length(x) > 420 THEN rtrim(left(x, 417), ' ') || '...' ELSE x END AS summary FROM f""",
    "paragraph_pieces": r"""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g'), '\n\s*\n'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: length(x) > 30) AS l FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, generate_subscripts(l, 1)::BIGINT AS pos, unnest(l) AS paragraph FROM p""",
    "fixed_token_windows": rf"""WITH p AS (SELECT doc_id, regexp_extract_all(text, '{TOK}') AS l FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, ceil(len(l) / 64)::BIGINT AS n_windows, array_to_string(l[1:64], ' ') AS first_window FROM p WHERE len(l) > 0""",
    "all_token_windows": rf"""WITH p AS (SELECT doc_id, regexp_extract_all(text, '{TOK}') AS l FROM documents WHERE text IS NOT NULL),
        w AS (SELECT doc_id, l, unnest(range(ceil(len(l) / 64)::BIGINT)) AS i FROM p)
        SELECT doc_id, i + 1 AS window_no, array_to_string(l[i * 64 + 1 : i * 64 + 64], ' ') AS "window" FROM w""",
    "line_frequencies": rf"""WITH l AS (SELECT DISTINCT source_file, chunk_row, lower({_squeeze('unnest(regexp_split_to_array(output, chr(13) || $$?\n$$))')}) AS line FROM source_chunks WHERE output IS NOT NULL)
        SELECT source_file, line, count(*) AS n_pages FROM l WHERE line <> '' GROUP BY ALL HAVING count(*) >= 3""",
    "document_ranks": "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY added_at NULLS FIRST, doc_id)::INT AS position FROM documents",
    "greedy_chunk_blocks": rf"""WITH RECURSIVE {_SIZED},
        f AS (SELECT source_file, chunk_total, volume, r, chunk_index AS "end", chunk_index AS start, n AS total, 1 AS k, 1 AS block_no FROM o WHERE r = 1 UNION ALL
              SELECT o.source_file, o.chunk_total, o.volume, o.r, o.chunk_index, CASE WHEN f.total + o.n <= 600 AND f.k < 4 THEN f.start ELSE o.chunk_index END, CASE WHEN f.total + o.n <= 600 AND f.k < 4 THEN f.total + o.n ELSE o.n END,
                     CASE WHEN f.total + o.n <= 600 AND f.k < 4 THEN f.k + 1 ELSE 1 END, CASE WHEN f.total + o.n <= 600 AND f.k < 4 THEN f.block_no ELSE f.block_no + 1 END
              FROM f JOIN o ON o.source_file = f.source_file AND o.chunk_total = f.chunk_total AND o.volume = f.volume AND o.r = f.r + 1)
        SELECT source_file, chunk_total, volume, block_no::INT AS block_no, max(start)::INT AS start, max("end")::INT AS "end", max(total)::INT AS n_tokens FROM f GROUP BY source_file, chunk_total, volume, block_no""",
    # from each start the last chunk of its window by running sums, then two thirds of it
    "segmented_files": rf"""WITH RECURSIVE {_SIZED}, s AS (SELECT *, sum(n) OVER (PARTITION BY source_file, chunk_total, volume ORDER BY r)::BIGINT AS upto FROM o),
        w AS (SELECT a.source_file, a.chunk_total, a.volume, a.r, count(*) AS k FROM s a JOIN s b ON a.source_file = b.source_file AND a.chunk_total = b.chunk_total AND a.volume = b.volume AND b.r >= a.r AND b.r < a.r + 8 AND (b.r = a.r OR b.upto - a.upto + a.n <= 900) GROUP BY ALL),
        f AS (SELECT source_file, chunk_total, volume, r AS pos, r + ceil(2 * k / 3)::BIGINT AS after, 1 AS block_no FROM w WHERE r = 1 UNION ALL
              SELECT w.source_file, w.chunk_total, w.volume, w.r, w.r + ceil(2 * k / 3)::BIGINT, block_no + 1 FROM f JOIN w ON w.source_file = f.source_file AND w.chunk_total = f.chunk_total AND w.volume = f.volume AND w.r = f.after)
        SELECT f.source_file, f.chunk_total, f.volume, block_no::INT AS block_no, min(chunk_index)::INT AS start, max(chunk_index)::INT AS "end", sum(n)::INT AS n_tokens
        FROM f JOIN o ON o.source_file = f.source_file AND o.chunk_total = f.chunk_total AND o.volume = f.volume AND o.r >= f.pos AND o.r < f.after GROUP BY f.source_file, f.chunk_total, f.volume, block_no""",
    "overlapping_word_chunks": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '{NSP}') AS l FROM documents WHERE text IS NOT NULL),
        p AS (SELECT doc_id, l, len(l) AS n, list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '[.!?]["'')\]]?$')) AS stops FROM w WHERE len(l) > 0),
        f AS (SELECT doc_id, 0::BIGINT AS pos, 0 AS piece_no, 0::BIGINT AS a, 0::BIGINT AS z, FALSE AS stop FROM p UNION ALL
              SELECT doc_id, greatest(e - 90, pos + 1), piece_no + 1, pos, e, e >= n FROM (SELECT f.doc_id, f.pos, f.piece_no, p.n, CASE WHEN f.pos + 700 >= p.n THEN p.n ELSE coalesce(list_max(list_filter(p.stops, lambda i: i <= least(f.pos + 540, p.n) AND i >= least(f.pos + 220, p.n) AND i > f.pos)), f.pos + 700) END AS e FROM f JOIN p USING (doc_id) WHERE NOT f.stop)),
        c AS (SELECT doc_id, piece_no, a, z, max(piece_no) OVER (PARTITION BY doc_id) AS last FROM f WHERE piece_no > 0),
        m AS (SELECT *, piece_no = last AND last > 1 AND z - a < 73 AS tail FROM c)
        SELECT doc_id, (CASE WHEN tail THEN piece_no - 1 ELSE piece_no END)::INT AS piece_no, string_agg(array_to_string(l[a + 1 : z], ' '), ' ' ORDER BY m.piece_no) AS piece FROM m JOIN p USING (doc_id) GROUP BY 1, 2""",
    "capped_pieces": rf"""WITH RECURSIVE d AS (SELECT doc_id, text, {_tokens("text")} AS n FROM documents WHERE text IS NOT NULL),
        p AS (SELECT doc_id, unnest(l) AS par, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n+'), lambda x: {_strip("x")}), lambda x: x <> '') AS l FROM d WHERE n > 200)),
        s AS (SELECT doc_id, i, unnest(l) AS part, generate_subscripts(l, 1) AS j FROM (SELECT doc_id, i, CASE WHEN {_tokens("par")} <= 200 THEN [par] ELSE list_filter(list_transform(string_split(regexp_replace(par, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: {_strip("x")}), lambda x: x <> '') END AS l FROM p)),
        z AS (SELECT doc_id, i, j, part, {_tokens("part")} AS n, greatest(1200, length(part) * 200 // greatest(1, {_tokens("part")})) AS step FROM s),
        u AS (SELECT doc_id, i, j, k, n > 200 AS alone, CASE WHEN n > 200 THEN {_strip("substring(part, k::BIGINT + 1, step::BIGINT)")} ELSE part END AS part FROM (SELECT *, unnest(CASE WHEN n > 200 THEN range(0, length(part), step::BIGINT) ELSE [0] END) AS k FROM z)),
        o AS (SELECT *, {_tokens("part")} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, j, k) AS r FROM u WHERE part <> ''),
        f AS (SELECT doc_id, r, part, n AS used, alone, 1 AS piece_no FROM o WHERE r = 1 UNION ALL
              SELECT o.doc_id, o.r, o.part, CASE WHEN o.alone OR f.alone OR f.used + o.n > 200 THEN o.n ELSE f.used + o.n END, o.alone, CASE WHEN o.alone OR f.alone OR f.used + o.n > 200 THEN f.piece_no + 1 ELSE f.piece_no END FROM f JOIN o ON o.doc_id = f.doc_id AND o.r = f.r + 1)
        SELECT doc_id, piece_no::INT AS piece_no, string_agg(part, chr(10) || chr(10) ORDER BY r) AS piece FROM f GROUP BY doc_id, piece_no UNION ALL SELECT doc_id, 1, text FROM d WHERE n <= 200 AND {_strip("text")} <> ''""",
    # gaps between tokens tell where words start; a piece is its tokens with the gaps inside it
    "word_boundary_pieces": rf"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(text, '{TOK}') AS l, regexp_split_to_array(text, '{TOK}') AS s FROM documents WHERE text IS NOT NULL),
        p AS (SELECT doc_id, l, s, len(l) AS n, list_filter(range(0, len(l)), lambda i: i = 0 OR length(s[i + 1]) > 0) AS w FROM t WHERE len(l) > 0),
        f AS (SELECT doc_id, 0::BIGINT AS a, 0::BIGINT AS z, 0 AS piece_no FROM p UNION ALL
              SELECT f.doc_id, f.z, least(p.n, CASE WHEN f.z + 128 < p.n THEN coalesce(list_min(list_filter(p.w, lambda i: i >= f.z + 128 AND i < least(p.n, f.z + 161))), list_max(list_filter(p.w, lambda i: i < f.z + 128 AND i > greatest(f.z, f.z + 95))), f.z + 128) ELSE p.n END), piece_no + 1 FROM f JOIN p USING (doc_id) WHERE f.z < p.n),
        u AS (SELECT doc_id, piece_no, a, unnest(range(a, z)) AS i FROM f WHERE piece_no > 0)
        SELECT doc_id, piece_no::INT AS piece_no, string_agg(CASE WHEN i > a THEN s[i + 1] ELSE '' END || l[i + 1], '' ORDER BY i) AS piece FROM u JOIN p USING (doc_id) GROUP BY doc_id, piece_no""",
    # headings are marked thrice, as marks found at once do not overlap
    "prechunked": rf"""WITH RECURSIVE d AS (SELECT doc_id, text, list_filter(string_split({_MARKED}, chr(30)), lambda x: {_strip("x")} <> '') AS h FROM documents WHERE text IS NOT NULL),
        q AS (SELECT doc_id, CASE WHEN len(h) > 1 THEN h ELSE list_filter(regexp_split_to_array(text, '\n\s*\n'), lambda x: {_strip("x")} <> '') END AS l FROM d),
        p AS (SELECT doc_id, {_strip("unnest(l)")} AS part, generate_subscripts(l, 1) AS i FROM q),
        s AS (SELECT doc_id, i, unnest(l) AS piece, generate_subscripts(l, 1) AS j FROM (SELECT doc_id, i, CASE WHEN {_tokens("part")} <= 200 THEN [part] ELSE list_filter(string_split(regexp_replace(part, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: x <> '') END AS l FROM p)),
        o AS (SELECT *, {_tokens("piece")} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS r FROM s),
        f AS (SELECT doc_id, i, r, piece, n AS used, 1 AS piece_no FROM o WHERE r = 1 UNION ALL
              SELECT o.doc_id, o.i, o.r, o.piece, CASE WHEN o.i <> f.i OR f.used + o.n > 200 THEN o.n ELSE f.used + o.n END, CASE WHEN o.i <> f.i OR f.used + o.n > 200 THEN f.piece_no + 1 ELSE f.piece_no END FROM f JOIN o ON o.doc_id = f.doc_id AND o.r = f.r + 1)
        SELECT doc_id, piece_no::INT AS piece_no, string_agg(piece, ' ' ORDER BY r) AS piece FROM f GROUP BY doc_id, piece_no""",
    "outline_sections": """WITH c AS (SELECT *, chunk_row - chunk_index AS volume FROM source_chunks WHERE source_file IS NOT NULL), m AS (SELECT source_file, max(end_page) AS last FROM c GROUP BY 1),
        f AS (SELECT source_file, start_page, arg_min(coalesce(source_title, 'Document'), volume * 1000000 + chunk_index) AS title FROM c WHERE start_page IS NOT NULL GROUP BY 1, 2)
        SELECT source_file, title, start_page, greatest(start_page, coalesce(lead(start_page) OVER (PARTITION BY source_file ORDER BY start_page) - 1, last))::INT AS end_page, 2::INT AS depth FROM f JOIN m USING (source_file)""",
    "page_line_counts": r"""WITH l AS (SELECT source_file, unnest(x) AS line, generate_subscripts(x, 1) - 1 AS line_no FROM (SELECT source_file, regexp_split_to_array(output, '\r?\n') AS x FROM source_chunks WHERE output IS NOT NULL))
        SELECT source_file, count(*) AS n, count(*) FILTER (trim(line) = '') AS n_blank, max(line_no)::INT AS last FROM l GROUP BY 1""",
    "word_counts_checked": rf"SELECT * FROM (SELECT chunk_row, word_count, len(regexp_extract_all(output, '{NSP}'))::INT AS words FROM source_chunks WHERE output IS NOT NULL) WHERE word_count IS NULL OR word_count <> words",
    "book_sections": rf"""WITH c AS (SELECT * FROM source_chunks WHERE start_page IS NOT NULL AND source_file IS NOT NULL), p AS (SELECT source_file, start_page AS page, string_agg(output, chr(10) || chr(10) ORDER BY chunk_row) AS text FROM c GROUP BY 1, 2),
        n AS (SELECT source_file, start_page AS page, arg_min(source_title, chunk_row) AS title FROM c WHERE source_title IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT source_file, title, page, coalesce(lead(page) OVER (PARTITION BY source_file ORDER BY page) - 1, 2147483647) AS last FROM n),
        t AS (SELECT s.source_file, s.title, s.page AS start_page, max(p.page) AS end_page, string_agg(p.text, chr(10) || chr(10) ORDER BY p.page) AS text FROM s JOIN p ON p.source_file = s.source_file AND p.page BETWEEN s.page AND s.last GROUP BY 1, 2, 3)
        SELECT source_file, title, start_page, end_page, length(text)::INT AS n_chars FROM t WHERE len(regexp_extract_all(text, '\S+')) >= 80""",
    "heading_questions": rf"""WITH l AS (SELECT doc_id, text, list_filter(list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: trim(x, ' ')), lambda x: regexp_matches(x, '^[\p{{Lu}}\p{{N}}#]') AND NOT regexp_matches(x, '[.!?;:,]$') AND length(x) BETWEEN 3 AND 80)[1:3] AS h FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, array_to_string(h, '|') AS headings, 'What does the text say about: ' || left(coalesce(h[1], string_split(regexp_replace({_squeeze("text")}, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31))[1], ''), 80) || '?' AS question FROM l""",
    "conversations": r"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?m)^(user|assistant): ', 1) AS roles, regexp_split_to_array(text, '(?m)^(?:user|assistant): ') AS parts FROM documents WHERE text IS NOT NULL AND doc_type = 'qa_record'),
        t AS (SELECT doc_id, unnest(roles) AS role, generate_subscripts(roles, 1) AS i, parts FROM d)
        SELECT doc_id, string_agg('<' || role || '> ' || regexp_replace(parts[i + 1], '[\s\x{b}]+', ' ', 'g'), ' ' ORDER BY i) AS value FROM t GROUP BY 1""",
    "names_and_sizes": r"""WITH p AS (SELECT p_partkey, p_size, 'org/' || replace(p_name, ' ', '-') || '-' || p_size || 'B-a3B-GGUF' AS n FROM part)
        SELECT p_partkey, p_size * 1e9::DOUBLE AS parameters, 3.0::DOUBLE AS active, regexp_replace(n, '-GGUF$', '') AS base, p_size::INT AS layer, p_size::BIGINT * 1000000 AS bytes,
        CASE WHEN p_size BETWEEN 1 AND 40 THEN p_size::INT ELSE NULL END AS boundary, CASE WHEN p_size BETWEEN 1 AND 30 THEN p_size::INT END AS last, p_size + 0.25::DOUBLE AS perplexity, 'http://h/' || p_size AS api,
        '{"a":' || p_size || '}' AS json, CASE WHEN p_size IN (7, 9) THEN '{"a":"' || p_size || '"}' END AS chosen, p_size::BIGINT * 1000000000 AS anywhere, p_size::INT AS billions, CASE WHEN p_size > 25 THEN 'Q4_K' ELSE 'imatrix' END AS quantization, split_part(n, '/', 2) || '.imatrix|org_' || split_part(n, '/', 2) || '.imatrix|' || lower(split_part(n, '/', 2)) || '.imatrix' AS files FROM p""",
    "adaptive_windows": rf"""WITH {_SIZED}, w AS (SELECT *, sum(n) OVER (PARTITION BY source_file, chunk_total, volume ORDER BY chunk_index) AS used FROM o)
        SELECT source_file, chunk_total, volume, chunk_index, n::INT AS n_tokens, used::BIGINT AS used FROM w WHERE r = 1 OR (r <= 12 AND used <= 1500 AND NOT (r > 3 AND used - n >= 900))""",
    "headings": r"""WITH l AS (SELECT chunk_row, output, regexp_extract(left(output, 240), '^\s*([^\r\n]*\S)', 1) AS line FROM source_chunks WHERE output IS NOT NULL)
        SELECT chunk_row, regexp_matches(line, '(?i)^\s*(chapter|part|section)\s+\d+') OR regexp_matches(line, '^\s*\d+(\.\d+){1,3}\s+[A-Za-z]') OR regexp_matches(line, '^\s*[A-Z][A-Z0-9\s,:&/\-]{8,}$') AS is_heading,
        (SELECT sum(regexp_matches(left(output, 3500), '(?i)' || p)::INT)::INT FROM unnest(['\bcopyright\b', '\btable\s+of\s+contents\b', '\bcontents\b', '\bforeword\b', '\bpreface\b', '\backnowledg(e)?ments?\b', '\babout\s+the\s+author\b', '\bdedication\b', '\bisbn\b', '\bpublisher\b', '\bindex\b']) AS u(p)) AS front_matter FROM l""",
}
