"""Large groups: buckets cut into blocks, and one line in every document."""

from tissueloom.llm import lines, sketch


def test_blocks_by_members_and_by_shingles(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:180], f"y{i % 40}", *base[181:]])) for i in range(90)]
    rows += [(1000 + i, " ".join(f"{i}.{k}" for k in range(30))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(sketch.linked_components(docs, 85).collect())
    assert {r.component_id for r in whole if r.doc_id < 90} == {0}
    monkeypatch.setattr(sketch, "BLOCK", 7)
    assert sorted(sketch.linked_components(docs, 85).collect()) == whole
    monkeypatch.setattr(sketch, "BLOCK", 2_000)
    monkeypatch.setattr(sketch, "BLOCK_SHINGLES", 900)
    assert sorted(sketch.linked_components(docs, 85).collect()) == whole


def test_one_line_in_all_documents(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_LINES", 20)
    rows = [(i, f"a line that all hold\nown line number {i}\na line that all hold") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = {t.name for t in spark.catalog.listTables()}
    got = {r.doc_id: (r.n_dropped, r.kept) for r in lines.dedup_lines(docs).collect()}
    assert got == {i: (2 * (i > 0), f"own line number {i}" if i else rows[0][1]) for i in range(200)}
    assert {t.name for t in spark.catalog.listTables()} == before
