"""Pages of harvested records, and documents as files, on hand-made folders."""

import hashlib

import pytest

from tallyspark.sources import documents, marc, pages


def page(*ids):
    return '<?xml version="1.0"?><collection xmlns="http://www.loc.gov/MARC21/slim">' + "".join(f'<record><controlfield tag="001">{i}</controlfield><leader>é</leader></record>' for i in ids) + "</collection>"


def put(at, **queries):
    for q, made in queries.items():
        (at / q).mkdir(parents=True)
        for first, ids in made.items():
            (at / q / f"{first}.xml").write_text(page(*ids))


def summary(spark, at, **how):
    return {r.query: (r.pages, r.records, r.capped) for r in pages.summary(pages.read_pages(spark, f"file://{at}", **how)).collect()}


def test_pages_end_at_the_first_that_isnt_full(spark, tmp_path):
    put(tmp_path, short={1: [1, 2, 3], 4: [4, 5], 7: [6, 7, 8]}, full={1: [1, 2, 3], 4: [4, 5, 6]}, gap={1: [1, 2, 3], 7: [4]}, empty={1: []}, late={4: [1]}, odd={1: [1, 2, 3], 3: [9, 9, 9]})
    put(tmp_path, **{"a%20b%2F": {1: [1]}})
    (tmp_path / "short/notes.txt").write_text("no page")
    (tmp_path / "short/.1.part").write_text(page(77))
    got = summary(spark, tmp_path, page=3, guard=9)
    assert got == {"short": (2, 5, False), "full": (2, 6, False), "gap": (1, 3, False), "empty": (1, 0, False), "odd": (1, 3, False), "a b/": (1, 1, False)}


def test_a_query_without_end_is_capped_and_told(spark, tmp_path):
    put(tmp_path, many={1: [1, 2], 3: [3, 4], 5: [5, 6], 7: [7, 8]}, some={1: [1, 2], 3: [3, 4], 5: [5]})
    assert summary(spark, tmp_path, page=2, guard=6) == {"many": (3, 6, True), "some": (3, 5, False)}
    assert summary(spark, tmp_path, page=2) == {"many": (4, 8, False), "some": (3, 5, False)}


def test_partitions_are_pages(spark, tmp_path):
    put(tmp_path, y={1: [1, 2], 3: [3, 4], 5: [5]}, z={1: [8]})
    spark.dataSource.register(pages.Pages)
    raw = spark.read.format("marc_pages").option("page", 2).load(f"file://{tmp_path}")
    assert raw.rdd.getNumPartitions() == 4
    assert sorted((r.query, r.first, r.n) for r in raw.collect()) == [("y", 1, 2), ("y", 3, 2), ("y", 5, 1), ("z", 1, 1)]


def test_records_of_pages_are_parsed_once(spark, tmp_path):
    put(tmp_path, y={1: [1, 2], 3: [2, 3]}, z={1: [3]})
    rows = pages.records(pages.read_pages(spark, f"file://{tmp_path}", page=2))
    assert rows.count() == 5
    assert sorted(r.record_id for r in marc.parse(rows).collect()) == ["1", "2", "3"]


def test_no_pages(spark, tmp_path):
    assert summary(spark, tmp_path) == {} and summary(spark, tmp_path / "nowhere") == {}


def test_written_pages_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(q, k, f'<record><controlfield tag="001">{k}</controlfield></record>') for q, n in (("a/b", 7), ("c", 6), ("é", 1)) for k in range(n)], "query string, k long, xml string").repartition(5)
    for _ in range(2):  # a second writing changes nothing
        made = sorted(map(tuple, pages.write_pages(rows, f"file://{tmp_path}", 3).collect()))
        assert made == [("a/b", 1, 3), ("a/b", 4, 3), ("a/b", 7, 1), ("c", 1, 3), ("c", 4, 3), ("é", 1, 1)]
        assert summary(spark, tmp_path, page=3) == {"a/b": (3, 7, False), "c": (2, 6, False), "é": (1, 1, False)}
    got = sorted((r.file, r.pos.block, r.pos.row, r.record.controlfield[0]._VALUE) for r in pages.records(pages.read_pages(spark, f"file://{tmp_path}", page=3)).collect())
    assert got == sorted((q, k // 3 * 3 + 1, k % 3, str(k)) for q, n in (("a/b", 7), ("c", 6), ("é", 1)) for k in range(n))


BLOB = bytes(range(256)) * 4


@pytest.fixture
def written(spark, tmp_path):
    rows = [
        ("E/CN.4/1", "E/x y.PDF", BLOB), ("E_CN.4_1", "E/z.pdf", b"other" * 200), ("E/CN.4/1", "E/x y.PDF", BLOB), ("tiny", "E/t.doc", b"x" * 499), ("edge", "E/t.doc", b"x" * 500),
        ("none", None, BLOB), ("blank", "", BLOB), ("no data", "E/n.doc", None), ("bare", "E/noending", BLOB), ("é", "E/é.doc", BLOB), (None, "E/null.doc", BLOB),
    ]
    log = documents.write_documents(spark.createDataFrame(rows, "symbol string, link string, data binary"), f"file://{tmp_path}/docs")
    return {r.symbol: (r.status, r.file) for r in log.collect()}


def test_documents_and_their_log(spark, tmp_path, written):
    other = written.pop("E_CN.4_1")
    assert written == {
        "E/CN.4/1": ("ok", "E_CN.4_1.pdf"), "tiny": ("tiny", "E/t.doc"), "edge": ("ok", "edge.doc"), "none": ("missing", ""), "blank": ("missing", ""),
        "no data": ("missing", ""), "bare": ("ok", "bare"), "é": ("ok", "x_.doc"), None: ("ok", "x.doc"),
    }
    assert other[0] == "ok" and other[1].startswith("E_CN.4_1~") and other[1].endswith(".pdf")
    back = {r.file: (r.n_bytes, bytes(r.data)) for r in documents.read_documents(spark, f"file://{tmp_path}/docs").collect()}
    assert back == {"E_CN.4_1.pdf": (1024, BLOB), other[1]: (1000, b"other" * 200), "edge.doc": (500, b"x" * 500), "bare": (1024, BLOB), "x_.doc": (1024, BLOB), "x.doc": (1024, BLOB)}


def test_sizes_are_read_without_the_documents(spark, tmp_path, written):
    sizes = documents.read_documents(spark, f"file://{tmp_path}/docs").select("file", "n_bytes")
    assert "content" not in sizes._jdf.queryExecution().executedPlan().toString()


def test_a_lost_attempt_leaves_nothing_to_read(spark, tmp_path):
    at = tmp_path / "docs"
    at.mkdir()
    (at / "_0123").write_bytes(b"half")
    rows = spark.createDataFrame([("a", "E/a.pdf", BLOB)], "symbol string, link string, data binary")
    for _ in range(2):
        documents.write_documents(rows, f"file://{at}")
    assert [(r.file, hashlib.sha256(r.data).digest()) for r in documents.read_documents(spark, f"file://{at}").collect()] == [("a.pdf", hashlib.sha256(BLOB).digest())]
