"""Text scalars as Column expressions (no UDFs): X1-X26.

Patterns name their character classes by Unicode property, so that Spark and
other engines read them alike. Null in, null out unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A run of letters, digits and underscores, or any other single character that is not Unicode white space.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{IsWhite_Space}\x{1C}-\x{1F}]"
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
WORD = r"[^\s\p{Z}\x1c-\x1f\x85]+"
THINK = r"(?is)<think>.*?(?:</think>|\z)"
SENTENCE_END = r"(?<=[.!?])\s+"


def token_count(text: Column) -> Column:
    """Number of tokens of ``text``."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("int")


def tokens(text: Column) -> Column:
    """The tokens in order."""
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), 1)


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def word_count(text: Column) -> Column:
    """X2."""
    return F.regexp_count(text, F.lit(WORD)).cast("int")


def tokens_by_words(text: Column) -> Column:
    """Three quarters of the number of words, rounded down."""
    return F.floor(word_count(text) * 0.75).cast("int")


def tokens_by_chars(text: Column) -> Column:
    """A quarter of the number of characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("int")


def squeeze(text: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.btrim(F.regexp_replace(text, f"{SPACE}+", " "))


def generated(text: Column) -> Column:
    """Squeezed, without quotation marks around it."""
    return F.btrim(squeeze(text), F.lit(" \"'"))


def without_thinking(text: Column) -> Column:
    """Without think tags and what they hold; an open tag reaches to the end."""
    return F.btrim(F.regexp_replace(text, THINK, ""), F.lit(" \t\n\r"))


def only_thinking(text: Column) -> Column:
    """Whether there is nothing but thinking."""
    return (without_thinking(text) == "") & (F.btrim(text) != "")


def is_timeout(message: Column) -> Column:
    """whether an error tells of a time-out."""
    return message.rlike(r"(?i)time(?:d)?[ -]?out")


def is_rate_limited(message: Column) -> Column:
    """whether an error tells of too many requests."""
    return message.rlike(r"(?i)\b429\b|rate[ _-]?limit|too many requests")


def tag(text: Column, name: str) -> Column:
    """What the first pair of tags holds, squeezed; null without one."""
    return F.nullif(squeeze(F.regexp_extract(text, rf"(?is)<{name}>(.*?)</{name}>", 1)), F.lit(""))


def tags(text: Column, name: str) -> Column:
    """What every pair of tags holds."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"(?is)<{name}>(.*?)</{name}>"), 1), squeeze)


def tag_or_text(text: Column, name: str) -> Column:
    """What the first pair of tags holds, as generated (X5); without a pair the whole text less stray tags; no thinking, empty for null."""
    t = F.coalesce(without_thinking(text), F.lit(""))
    inner = F.regexp_extract(t, rf"(?is)<{name}>\s*(.*?)\s*</{name}>", 1)
    stray = F.regexp_replace(generated(t), rf"(?is)^<{name}>\s*|\s*</{name}>$", "")
    return F.when(t.rlike(rf"(?is)<{name}>.*?</{name}>"), generated(inner)).otherwise(generated(stray))


_SCORED = r'(?is)<q(?:\s+score\s*=\s*"?(-?[0-9.]+)"?)?\s*>(.*?)</q>'


def scored_questions(text: Column) -> Column:
    """Array of ``(pos, score, question)`` of tags ``<q score="n">``; score 0 where there is none."""
    scores = F.regexp_extract_all(text, F.lit(_SCORED), 1)
    questions = F.regexp_extract_all(text, F.lit(_SCORED), 2)
    pairs = F.transform(F.arrays_zip(scores.alias("s"), questions.alias("q")), lambda x, i: F.struct(i.alias("pos"), F.coalesce(x["s"].try_cast("double"), F.lit(0.0)).alias("score"), squeeze(x["q"]).alias("question")))
    return F.filter(pairs, lambda x: x["question"] != "")


def sentences(text: Column) -> Column:
    """Split after a full stop, exclamation or question mark that white space follows."""
    return F.split(text, SENTENCE_END)


def extractive_summary(text: Column, n: int = 2, limit: int = 420) -> Column:
    """The first sentences, cut to ``limit`` characters with three dots."""
    first = F.array_join(F.slice(sentences(squeeze(text)), 1, n), " ")
    return F.when(F.length(first) > limit, F.concat(F.rtrim(F.substring(first, 1, limit - 3)), F.lit("..."))).otherwise(first)


def clean_page(text: Column) -> Column:
    """X11: words broken over lines joined (ASCII letters on both sides), single line ends as blanks, blank lines and blanks squeezed."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"([A-Za-z])-\n([A-Za-z])", "$1$2")
    t = F.regexp_replace(t, r"(?<!\n)\n(?!\n)", " ")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.btrim(F.regexp_replace(t, r"[ \t]+", " "), F.lit(" \t\n\r"))


def sanitize_name(name: Column) -> Column:
    """Blanks as underscores, only letters, digits, underscores, hyphens and full stops kept."""
    return F.regexp_replace(F.replace(name, F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}_.\-]", "")


def _ints(text: Column, pattern: str, low: int, high: Column | int) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda x: x.try_cast("int"))
    return F.filter(found, lambda x: x.between(F.lit(low), high if isinstance(high, Column) else F.lit(high)))


def boundary_index(text: Column, n: Column) -> Column:
    """The index in 1..n that an answer names: the last labelled one, else the last alone on its line, else the last number in range."""
    t = without_thinking(text)
    labelled = _ints(t, r"(?i)(?:final answer|answer|index|boundary|chunk)\"?\s*[:=]?\s*\"?(\d+)", 1, n)
    alone = _ints(t, r"(?m)^\s*(\d+)\s*$", 1, n)
    some = _ints(t, r"(?<![\d.])(\d+)(?![\d])", 1, n)
    return F.coalesce(*(F.try_element_at(x, F.lit(-1)) for x in (labelled, alone, some)))


def last_int(text: Column, low: int, high: int) -> Column:
    """The last number of one to four digits, if in range."""
    last = F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?<!\d)(\d{1,4})(?!\d)"), 1), F.lit(-1)).try_cast("int")
    return F.when(last.between(low, high), last)


def yes_no(text: Column, whole_words: bool = True) -> Column:
    """True or false by which of yes and no comes first; without either false where only ``false`` is said, else true, also for null and empty texts.

    ``whole_words=False`` also finds yes and no inside words.
    """
    t = F.lower(F.coalesce(without_thinking(text), F.lit("")))
    edge = r"\b" if whole_words else ""
    yes, no = (F.regexp_instr(t, F.lit(f"{edge}{w}{edge}")) for w in ("yes", "no"))
    return F.when((yes > 0) & (no > 0), yes < no).when(yes > 0, True).when(no > 0, False).otherwise(F.contains(t, F.lit("true")) | ~F.contains(t, F.lit("false")))


def parameters_from_name(name: Column) -> Column:
    """Number of parameters named in a model's name (7B, 1.5b, 350M); null without one."""
    number = F.regexp_extract(name, r"(?i)(\d+(?:\.\d+)?)\s*([bm])(?![a-z0-9])", 1).try_cast("double")
    unit = F.lower(F.regexp_extract(name, r"(?i)(\d+(?:\.\d+)?)\s*([bm])(?![a-z0-9])", 2))
    return F.when(unit == "b", number * 1e9).when(unit == "m", number * 1e6)


def parameters_anywhere(name: Column) -> Column:
    """The first number before a b or m, wherever it stands (``7bit`` counts), as a whole number."""
    number, unit = (F.regexp_extract(name, r"(?i)(\d+\.?\d*)\s*([bm])b?", i) for i in (1, 2))
    return F.floor(number.try_cast("double") * F.when(F.lower(unit) == "b", 1e9).when(F.lower(unit) == "m", 1e6)).cast("bigint")


def billions_from_name(name: Column) -> Column:
    """The first whole number directly before a b, in billions."""
    return F.regexp_extract(F.lower(name), r"(\d+)b", 1).try_cast("int")


def quantization_of(name: Column, known: list[str]) -> Column:
    """The first known type that ends a file's name (``-TYPE.gguf``), else ``imatrix`` or ``bf16`` where the name says so; else null."""
    hit = F.get(F.filter(F.array(*map(F.lit, known)), lambda k: F.contains(name, F.concat(F.lit("-"), k, F.lit(".gguf")))), F.lit(0))
    low = F.lower(name)
    return F.coalesce(hit, F.when(F.contains(low, F.lit("imatrix")), "imatrix").when(F.contains(low, F.lit("bf16.gguf")), "bf16"))


def expert_size(name: Column) -> Column:
    """Active parameters of a mixture of experts (-a3b-), in billions."""
    return F.nullif(F.regexp_extract(F.lower(name), r"-a(\d+(?:\.\d+)?)b(?:-|$)", 1), F.lit("")).try_cast("double")


def base_name(name: Column) -> Column:
    """Without shard number, file suffix and the suffix of converted models."""
    t = F.regexp_replace(name, r"-\d{5}-of-\d{5}", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?i)\.(?:gguf|safetensors|json|parquet)$", ""), r"(?i)-gguf$", "")


def layer_of(tensor: Column) -> Column:
    """Number of the layer in a tensor's name, -1 without one."""
    return F.coalesce(F.regexp_extract(tensor, r"blk\.(\d+)\.", 1).try_cast("int"), F.lit(-1))


def glob_match(text: Column, pattern: Column) -> Column:
    """Whether the whole text matches a pattern in which ``*`` stands for anything."""
    escaped = F.regexp_replace(pattern, r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.call_function("rlike", text, F.concat(F.lit("^"), F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("$")))


def perplexity(log: Column) -> Column:
    """Perplexity from a log: the final estimate, else ``perplexity = x``, else the last chunk's value."""
    final = F.regexp_extract(log, r"(?i)final estimate:\s*ppl\s*=\s*([0-9.]+)", 1)
    named = F.regexp_extract(log, r"(?i)perplexity\s*[:=]\s*([0-9.]+)", 1)
    chunk = F.try_element_at(F.regexp_extract_all(log, F.lit(r"\[\d+\]\s*([0-9.]+)"), 1), F.lit(-1))
    return F.coalesce(*(F.nullif(x, F.lit("")).try_cast("double") for x in (final, named, chunk)))


def heading_lines(text: Column, n: int = 3, longest: int = 80) -> Column:
    """The first lines that look like headings: short, no sentence end, beginning with a capital letter or digit."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.btrim(x))
    return F.slice(F.filter(lines, lambda x: x.rlike(r"^[\p{Lu}\p{N}#]") & ~x.rlike(r"[.!?;:,]$") & F.length(x).between(3, longest)), 1, n)


def fallback_question(text: Column) -> Column:
    """A question made from the first heading, else from the first sentence."""
    subject = F.coalesce(F.get(heading_lines(text, 1), F.lit(0)), F.get(sentences(squeeze(text)), F.lit(0)), F.lit(""))
    return F.concat(F.lit("What does the text say about: "), F.substring(subject, 1, 80), F.lit("?"))


def json_object(text: Column) -> Column:
    """From the first opening to the last closing brace if that parses as JSON, else null."""
    span = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(span).isNotNull() & (span != ""), span)


def json_with(text: Column, required: list[str], allowed: dict[str, list[str]] | None = None) -> Column:
    """``json_object`` if it has all required fields, and fields with allowed values have one of them; else null."""
    found = json_object(text)
    ok = F.lit(True)
    for k in required:
        ok = ok & F.get_json_object(found, f"$.{k}").isNotNull()
    for k, values in (allowed or {}).items():
        ok = ok & F.coalesce(F.get_json_object(found, f"$.{k}").isin(values), F.lit(False))
    return F.when(ok, found)


def bytes_of_size(size: Column) -> Column:
    """``10K``, ``5M``, ``2G`` or a plain number, decimal."""
    number = F.regexp_extract(F.upper(F.btrim(size)), r"^(\d+)([KMG]?)B?$", 1).try_cast("bigint")
    unit = F.regexp_extract(F.upper(F.btrim(size)), r"^(\d+)([KMG]?)B?$", 2)
    return number * F.when(unit == "K", 1_000).when(unit == "M", 1_000_000).when(unit == "G", 1_000_000_000).otherwise(1)


def api_base(url: Column) -> Column:
    """Without the path of a completion call and closing slashes."""
    return F.regexp_replace(F.regexp_replace(F.btrim(url), r"/+$", ""), r"/(?:chat/)?completions$", "")


def file_candidates(model_id: Column) -> Column:
    """Names under which a model's importance file may be stored."""
    org, name = F.split_part(model_id, F.lit("/"), F.lit(1)), F.split_part(model_id, F.lit("/"), F.lit(2))
    return F.array_distinct(F.array(F.concat(name, F.lit(".imatrix")), F.concat(org, F.lit("_"), name, F.lit(".imatrix")), F.concat(F.lower(name), F.lit(".imatrix"))))
