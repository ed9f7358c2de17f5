"""Small ingest records for the tests."""

SCHEMA = """row_no bigint, loaded_at timestamp, input string, summary string, output string, alt_question_1 string, alt_question_2 string, alt_question_3 string,
doc_id string, chunk_id string, chunk_index int, chunk_count int, chunk_start int, chunk_end int, semantic_block_index int, source_title string, source_file string,
page_start int, page_end int"""
NAMES = [c.split()[0] for c in SCHEMA.replace("\n", " ").split(", ") if c.split()]


def records(spark, rows: list[dict]):
    data = []
    for i, r in enumerate(rows, 1):
        r = {"row_no": i, "doc_id": "d", "chunk_id": f"d:{i}", "source_file": "f.json", "source_title": "A Title", "chunk_start": 1, "chunk_end": 1} | r
        data.append(tuple(r.get(n.strip()) for n in NAMES))
    # columns that clash with names the operators use inside
    extra = "".join(f", `{n}` string" for n in ("text", "n", "title", "key", "h", "k", "cap", "salt", "lang", "titles", "line_no"))
    return spark.createDataFrame([(*d, *("x",) * 11) for d in data], SCHEMA + extra)
