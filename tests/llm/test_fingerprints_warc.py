import random

import pytest
from pyspark.sql import functions as F

import voltstream.llm.fingerprints as fingerprint_module
from voltstream.llm.fingerprints import (
    changed_paragraphs,
    compare_with_edit,
    edited_paragraphs,
    fingerprints,
    likeness,
    merkle_tree,
)
from voltstream.llm.warc import capture_index, loser_tree, read_runs, url_key, write_archives


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id BIGINT, text STRING, root STRING")


def test_equal_texts_have_equal_fingerprints_only(spark):
    texts = ["", None, "a", "a\n", "a\n\nb", "a\nb", "a b", " a b", "x" * 500, "x" * 501, "é, ü. ß"]
    rows = fingerprints(docs(spark, *((n, t, "clash") for n, t in enumerate(texts)))).collect()
    for a in rows:
        for b in rows:
            same = (texts[a.doc_id] or "") == (texts[b.doc_id] or "")
            assert (a.fingerprint == b.fingerprint) == (a.root == b.root) == same


def test_edits_are_located(spark):
    text = "one line.\nand two.\n\nnext part.\nits end."
    frame = docs(spark, (1, text, text.replace("its end", "another end")))
    places = frame.select(edited_paragraphs(merkle_tree("root"), merkle_tree("text")).alias("p")).first().p
    assert [tuple(p) for p in places] == [(1, 1)]
    same = frame.select(edited_paragraphs(merkle_tree("text"), merkle_tree("text")).alias("p")).first().p
    assert same == []


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_edit_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(fingerprint_module, "BLOCK", block)
    texts = {None: "lowest of all texts", -5: None, 0: "", 7: "seven words stand here, and so on", 2**62: "äöü" * 50}
    frame = docs(spark, *((k, t, None) for k, t in texts.items()))
    got = {r.doc_id: r for r in compare_with_edit(frame).collect()}
    order = sorted(texts, key=lambda k: (k is not None, k or 0), reverse=True)
    import hashlib

    for n, key in enumerate(order):
        text, following = texts[key] or "", texts[order[(n + 1) % len(order)]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert got[key].n_chars == len(text)
        assert got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[key].near_edited == 1) == (edited == text)
    assert compare_with_edit(frame.where("false")).collect() == []
    (single,) = compare_with_edit(frame.where("doc_id = 7")).collect()
    assert single.near_next == 1


def test_repeated_ids_and_likeness(spark):
    frame = docs(spark, (1, "b", ""), (1, "a", ""), (1, "a", ""))
    assert compare_with_edit(frame).count() == 3
    pair = spark.sql("SELECT 'r:aaaaaabbbbbb' AS a, 's:bbbbbb.cccccc' AS b, 't:aaaaaabbbbbbcccccc' AS c")
    # Half of the phrases and none of the neighbours; four of five and four of seven.
    assert pair.select(likeness("a", "b")).first()[0] == 0.25
    assert abs(pair.select(likeness("a", "c")).first()[0] - (4 / 5 + 4 / 7) / 2) < 1e-12
    assert pair.select(changed_paragraphs("a", "b"), changed_paragraphs("b", "a")).first()[:] == (1, 2)


def test_texts_of_the_same_phrases_are_told_apart(spark):
    texts = ["bbbb, aaaa, ", "aaaa, bbbb, ", "aaaa, aaaa, aaaa, bbbb, ", "aaaa, aaaa, aaaa, aaaa, bbbb, "]
    rows = fingerprints(docs(spark, *((n, t, "") for n, t in enumerate(texts)))).select("doc_id", "fingerprint")
    other = rows.select(F.col("doc_id").alias("other"), F.col("fingerprint").alias("f"))
    found = rows.crossJoin(other).select("doc_id", "other", likeness("fingerprint", "f").alias("x")).collect()
    near = {(r.doc_id, r.other): r.x for r in found}
    assert all((near[a, b] == 1) == (a == b) and near[a, b] == near[b, a] for a, b in near)
    assert near[0, 1] == 0.5 < near[0, 2] + 0.5 and near[1, 2] > 0.8 and near[2, 3] > near[1, 2] / 1.1


@pytest.mark.parametrize("ids", ["one far off", "many null", "one hot"])
def test_blocks_are_even_wherever_the_ids_lie(spark, ids, monkeypatch):
    count = 20_000
    key = {
        "one far off": F.when(F.col("id") == 7, F.lit(10**15)).otherwise(F.col("id")),
        "many null": F.when(F.col("id") % 2 == 0, F.col("id")),
        "one hot": F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")),
    }[ids]
    rows = spark.range(count).select(key.cast("bigint").alias("id"), F.xxhash64("id").alias("h"))
    edges = fingerprint_module._edges(rows)
    blocks = rows.groupBy(fingerprint_module._block_of(F.struct("id", "h"), edges).alias("block")).count().collect()
    assert len(blocks) == -(-count // fingerprint_module.BLOCK)
    assert max(r["count"] for r in blocks) < 2 * fingerprint_module.BLOCK
    monkeypatch.setattr(fingerprint_module, "BLOCK", 7)
    frame = rows.select(F.col("id").alias("doc_id"), F.col("h").cast("string").alias("text"), F.lit("").alias("root"))
    odd = frame.where("doc_id IS NULL OR doc_id < 90 OR doc_id > 19950").limit(400)
    got = compare_with_edit(odd)
    assert got.count() == odd.count()


def test_a_third_of_a_long_text_costs_a_third_of_its_likeness(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(2000)]
    frame = docs(spark, (1, " ".join(words[:1000]), ""), (2, " ".join(words[1000:]), ""))
    for row in compare_with_edit(frame).collect():
        assert 0.6 < row.near_edited < 0.72 and row.near_next < 0.05


HTML = "<p>long enough to be stored once only, whatever its address, and to be found again</p>" * 2
PAGES = [
    (5, "http://www.b.org/x?q=1#top", HTML),
    (3, "https://a.org", HTML),
    (9, "http://a.org/", HTML),
    (1, None, "short"),
    (2, "not a url [", "short"),
    (4, "http://a.org/\r\nHost: evil", "line\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (6, "http://a.org/é", None),
    (3, "https://a.org", HTML),
    (None, "http://c.org", HTML),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING").withColumn("offset", F.lit("x"))


def assert_in_order(rows):
    keys = [(r.urlkey, r.captured, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    assert all((a.captured < b.captured) == (a.captured_at < b.captured_at) for a, b in zip(rows, rows[1:]))


def test_captures_of_any_page_id(spark):
    ids = [0, 1, -1, 3 * 10**11, 10**13, 2**62, -(2**62), 2**63 - 1, -(2**63), 7, 7, None]
    rows = [(n, "http://a.org/", f"{HTML}{n}") for n in ids]
    got = capture_index(spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")).collect()
    assert sorted(map(repr, ids)) == sorted(repr(r.page_id) for r in got)
    assert_in_order(got)
    assert {r.captured_at[4] for r in got} == {"-"}


def test_the_whole_table_is_in_one_order(spark, tables, monkeypatch):
    """Over several ranges and archives, each bounded."""
    monkeypatch.setattr("voltstream.llm.warc.RANGE_ROWS", 20)
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    index = capture_index(pages)
    assert index.rdd.getNumPartitions() >= pages.count() // 20
    got = index.collect()
    assert_in_order(got)
    assert sorted(r.page_id for r in got) == sorted(r.page_id for r in pages.select("page_id").collect())


def test_an_archive_ends_by_its_bytes(spark, tmp_path):
    rows = [(n, "http://a.org/", f"{n} " * 20_000) for n in range(40)]
    frame = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").coalesce(1)
    import pyarrow as pa

    from voltstream.llm import warc

    batch = pa.record_batch([pa.array(["x" * (12 << 20)] * 6 + [None] * 0)], names=["value"])
    assert [p.as_py() for b in warc._dealt(iter([batch, batch])) for p in b.column("part")] == [
        (12 << 20) * n // warc.BYTES_PER_FILE for n in range(12)
    ]
    write_archives(frame, str(tmp_path / "archives"))
    assert read_runs(spark, str(tmp_path / "archives")).count() == 40


def test_captures_of_odd_pages(spark, pages):
    rows = capture_index(pages).collect()
    assert len(rows) == len(PAGES)
    kinds = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in rows), key=repr)
    want = [(0, "response", None), (1, "response", None), (2, "response", None), (3, "response", None),
            (3, "response", None), (4, "response", None), (5, "revisit", 3), (6, "response", None), (9, "revisit", 3)]
    assert kinds == sorted(want, key=repr)
    by_id = {r.page_id: r for r in rows}
    assert by_id[9].payload_bytes == len(HTML.encode()) and by_id[9].payload_digest == by_id[3].payload_digest
    assert by_id[6].payload_bytes == 0
    assert_in_order(rows)
    assert capture_index(pages.where("false")).collect() == []


def test_records_lie_where_the_index_says(spark, pages, tmp_path):
    import gzip

    path = str(tmp_path / "archives")
    write_archives(pages, path)
    for r in read_runs(spark, path).collect():
        data = gzip.open(r.archive.removeprefix("file:")).read()[r.offset : r.offset + r.length]
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert (HTML.encode() in data) == (r.record_type == "response" and r.payload_bytes == len(HTML))


def test_loser_tree_merges_any_runs():
    rng = random.Random(4)
    for _ in range(500):
        runs = [sorted(rng.choices(range(20), k=rng.randrange(6))) for _ in range(rng.randrange(9))]
        assert list(loser_tree(runs, lambda x: x)) == sorted(sum(runs, []))


def test_url_keys():
    assert url_key("http://www.Example.org:8080/A/b?x=1#frag") == "org,example:8080)/a/b?x=1"
    assert url_key("https://example.org") == url_key("http://EXAMPLE.org/") == "org,example)/"
    assert url_key(None) == ")/" and url_key("http://[bad") == "http://[bad"
