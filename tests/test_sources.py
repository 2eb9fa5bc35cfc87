import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pagequarry.checks import record_checks
from pagequarry.operators.extract import extract_records
from pagequarry.plans import storage
from pagequarry.sources import pages as src
from pagequarry.sources.records import COLUMNS, read_records, write_records
from pagequarry.streaming.intake import (
    first_seen,
    first_seen_within,
    read_intake,
    read_page_stream,
    start_first_copies,
    start_intake,
)

ODD = ['he said "hi", twice', "a\nb", "back\\slash", "", "é,;", '"', "x\\"]


def test_records_round_trip(spark, tmp_path, rows):
    data = [(f"u{i}", *[ODD[(i + j) % len(ODD)] for j in range(9)]) for i in range(20)]
    records = spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))
    path = str(tmp_path / "records")
    assert write_records(records, path)
    assert rows(read_records(spark, path)) == rows(records)


def test_no_records_write_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "url string, name string")
    assert not write_records(empty, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    with pytest.raises(AnalysisException):
        read_records(spark, str(tmp_path / "none"))


def test_log_appends(spark, tmp_path, rows):
    pages = spark.createDataFrame([("http://h/a?x=\"1\",2", "é<p>")], "url string, html string")
    log = src.page_inventory(pages, F.lit("2024-01-02 03:04:05.678").cast("timestamp_ntz"))
    path = str(tmp_path / "log")
    src.append_log(log, path)
    src.append_log(log, path)
    assert rows(src.read_log(spark, path)) == [('http://h/a?x="1",2', "2024-01-02T03:04:05.678000", 5, "a")] * 2


def test_page_files(spark, tmp_path, rows):
    root = tmp_path / "html out"
    for name, data in {"a/index.html": b"A\r\n", "b+c/d%e é.html": "ü".encode(), "bad.html": b"\xff\xfe"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    assert rows(src.read_page_files(spark, str(root))) == [("a/index.html", "A\r\n"), ("b+c/d%e é.html", "ü")]


def test_page_files_lie_in_few_folders(spark, tmp_path, monkeypatch):
    count = 2 * 256
    pages = spark.createDataFrame([(i * 1_000_003, f"page {i}\r\né") for i in range(count)], "page_id bigint, html string")
    pages.repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(record_checks, "fresh_path", lambda *_: f"file://{tmp_path}/files")
    found = {r.page_id: r.digest for r in record_checks.page_files(spark, str(tmp_path)).collect()}
    assert found == {i * 1_000_003: hashlib.md5(f"page {i}\r\né\n".encode()).hexdigest() for i in range(count)}
    files = [f for f in (tmp_path / "files").rglob("*") if f.is_file() and not f.name.startswith((".", "_"))]
    assert len(files) == count
    assert len({f.parent for f in files}) <= 256


@pytest.mark.parametrize("mounted", [True, False])
def test_page_files_of_odd_rows(spark, tmp_path, rows, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(src, "mounted_path", lambda *_: None)
    data = [(-1, "minus"), (None, "no number"), (3, None), (4, "twice"), (4, "twice"), (5, "")]
    path = str(tmp_path / "files")
    src.write_page_files(spark.createDataFrame(data, "page_id bigint, html string").coalesce(1), path)
    back = src.read_page_files(spark, path).select(src.page_number("filepath_saved"), "html")
    expected = [(-1, "minus\n"), (None, "no number\n"), (3, "\n"), (4, "twice\ntwice\n"), (5, "\n")]
    assert rows(back) == sorted(expected, key=repr)


def test_page_files_keep_bytes_and_need_a_new_folder(spark, tmp_path):
    pages = spark.sql("SELECT 1L AS page_id, CAST(X'61FF' AS string) AS html")
    src.write_page_files(pages, str(tmp_path / "files"))
    assert [f.read_bytes() for f in (tmp_path / "files").rglob("page_id=*")] == [b"a\xff\n"]
    assert src.unreadable_files(spark, str(tmp_path / "files")).count() == 1
    with pytest.raises(FileExistsError):
        src.write_page_files(pages, str(tmp_path / "files"))
    src.write_page_files(pages.where("page_id > 1"), str(tmp_path / "none"))
    assert src.read_page_files(spark, str(tmp_path / "none")).count() == 0


def test_page_files_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(src, "SPLITS_A_TASK", 4)
    count = 400
    src.write_page_files(spark.range(count).select(F.col("id").alias("page_id"), F.lit("a").alias("html")), str(tmp_path / "files"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        back = src.read_page_files(spark, str(tmp_path / "files"))
        assert back.rdd.getNumPartitions() <= count // 4
        numbers = back.select(src.page_number("filepath_saved").alias("n"))
        assert sorted(r.n for r in numbers.collect()) == list(range(count))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_mounted_folders(spark):
    folders = ["/a/b/", "file:///a b/", "file:/a", "file://host/a", "hdfs://h/a", "viewfs:///a", "s3a://b/a", "a/b"]
    assert [src.mounted_path(spark, f) for f in folders] == ["/a/b", "/a b", "/a", None, None, None, None, None]
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.defaultFS", "hdfs://h")
    try:
        assert [src.mounted_path(spark, f) for f in folders[:2]] == [None, "/a b"]
    finally:
        settings.set("fs.defaultFS", before)


def test_queue_round_trip(spark, tmp_path):
    urls = [f"http://h/{(i * 7919) % 1000}" for i in range(1000)]
    queue = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, seq bigint").repartition(5)
    path = str(tmp_path / "queue")
    src.write_queue(queue, path)
    back = src.read_queue(spark, path).orderBy("seq").collect()
    assert [(r.url, r.seq) for r in back] == [(u, i) for i, u in enumerate(urls)]


def test_queue_file_lines_are_cleaned(spark, tmp_path):
    (tmp_path / "queue.txt").write_text("  b \n\na\nb\n\t\nc\n")
    back = src.read_queue(spark, str(tmp_path / "queue.txt")).orderBy("seq").collect()
    assert [r.url for r in back] == ["b", "a", "c"]


def test_robots_file(spark, tmp_path):
    (tmp_path / "robots.txt").write_text("User-agent: *\nDisallow: /x\n")
    assert src.read_robots(spark, str(tmp_path / "robots.txt")).first().text.count("\n") == 2


def test_last_page_of_a_path_wins(spark, tmp_path, rows):
    data = [("p", 1, "t1", "old"), ("p", 2, "t2", "new"), ("p", 3, "t1", "older"), ("q", 4, "t0", "only")]
    pages = spark.createDataFrame(data, "filepath_saved string, page_id int, at string, html string")
    src.save_pages(pages, str(tmp_path / "pages"), ["at", "page_id"])
    assert rows(spark.read.parquet(str(tmp_path / "pages")).select("page_id", "html")) == [(2, "new"), (4, "only")]
    collisions = src.path_collisions(pages, ["at", "page_id"]).collect()
    assert [(r.filepath_saved, r.n_pages, r.first_page.page_id, r.last_page.page_id) for r in collisions] == [("p", 3, 1, 2)]


@pytest.mark.parametrize("within", [False, True])
def test_stream_lets_each_url_through_once(spark, tmp_path, within):
    schema = "page_id bigint, url string, html string, at timestamp"
    source, sink, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def put(ids):
        urls = [(i, "hot" if i % 3 == 0 else f"u{i % 40}", "x") for i in ids]
        df = spark.createDataFrame(urls, "page_id bigint, url string, html string")
        df.withColumn("at", F.lit("2024-01-01").cast("timestamp")).repartition(3).write.mode("append").parquet(source)

    for ids in (range(0, 90), range(60, 150)):
        put(ids)
        stream = read_page_stream(spark, source, schema)
        once = first_seen_within(stream, "at", "1 hour") if within else first_seen(stream)
        start_intake(once, sink, state).awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == got.select("url").distinct().count() == 41


def test_shared_folder_comes_from_the_session(spark):
    assert storage.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/pagequarry/x-")
    back = storage.written(spark.range(5), "five")
    assert back.count() == 5 and back.inputFiles()[0].find("/pagequarry/five-") > 0


def test_rows_are_numbered_in_the_order_of_appending(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "url string, downloaded_at string, filesize_bytes bigint, filepath_saved string"
    urls = [f"http://h/{(i * 7919) % 500}" for i in range(500)]
    for part in (urls[:300], urls[300:320], urls[320:], urls[:40]):
        rows = [(u, "t", i, "f\n,\"x") for i, u in enumerate(part)]
        log = spark.createDataFrame(rows, schema).repartition(7)
        src.append_log(log, path, ["filesize_bytes"])
    back = src.read_log(spark, path, numbered=True).orderBy("seq").collect()
    assert [(r.seq, r.url) for r in back] == list(enumerate(urls + urls[:40]))
    assert src.read_log(spark, path).columns == back[0].__fields__[:-1]


def test_file_numbers_are_numbers(spark, tmp_path):
    write = "0f0f0f0f-0f0f-0f0f-0f0f-0f0f0f0f0f0f"
    for number in (99_999, 100_000, 5):
        (tmp_path / f"part-{number:05d}-{write}-c000.txt").write_text(f"{number}\n")
    back = src.read_queue(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.url for r in back] == ["5", "99999", "100000"]


def test_records_keep_the_order_of_the_log(spark, tmp_path):
    log = spark.createDataFrame([(f"u{i}", f"list/{i % 3}/index.html", i) for i in range(30)], "url string, filepath_saved string, seq bigint")
    html = [(f"list/{i}/index.html", f'<h1 class="primary_title">N{i}</h1>') for i in range(3)]
    pages = spark.createDataFrame(html, "filepath_saved string, html string")
    records = extract_records(log.repartition(4).unionByName(log), pages)
    path = str(tmp_path / "records")
    write_records(records, path, ["seq", "url"])
    back = read_records(spark, path, ["url", "name"], numbered=True).orderBy("seq").collect()
    assert [(r.url, r.name) for r in back] == [(f"u{i}", f"N{i % 3}") for i in range(30) for _ in range(2)]
    assert sorted(r.seq for r in extract_records(log.unionByName(log), pages, dedupe=True).collect()) == list(range(30))


def test_unreadable_files_are_named(spark, tmp_path):
    (tmp_path / "good.html").write_text("é")
    (tmp_path / "bad.html").write_bytes(b"\xff\xfe")
    assert [r.filepath_saved for r in src.unreadable_files(spark, str(tmp_path)).collect()] == ["bad.html"]
    assert [r.html for r in src.read_page_files(spark, str(tmp_path)).collect()] == ["é"]


@pytest.mark.parametrize("bits", [8, 1 << 20])
def test_many_losers_move_only_suspected_pages(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(src, "BITMAP_BITS", bits)
    data = [(f"p{i % 400}" if i % 4 else "hot", i, "t", f"page {i}") for i in range(1_000)]
    pages = spark.createDataFrame(data, "filepath_saved string, page_id int, at string, html string").repartition(4)
    kept = src.latest_pages(pages, ["at", "page_id"], limit=0)
    assert kept.columns == pages.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept) == rows(src.latest_pages(pages, ["at", "page_id"]))
    # the one exchange of whole pages lies behind the test of the bitmap
    assert plan.count("Union") == 1 and "NOT coalesce" in plan


def test_the_newest_queue_is_loaded(spark, tmp_path, rows):
    path = str(tmp_path / "queue")
    assert src.load_queue(spark, path).count() == 0
    for n in (3, 5, 0):
        src.save_queue(spark.createDataFrame([(f"u{i}", i + 7) for i in range(n)], src.QUEUE_SCHEMA), path)
        assert rows(src.load_queue(spark, path)) == [(f"u{i}", i + 7) for i in range(n)]
    # a version that was not finished does not count
    spark.createDataFrame([("half", 0)], src.QUEUE_SCHEMA).write.parquet(f"{path}/queues/broken")
    assert src.load_queue(spark, path).count() == 0


def test_the_first_copy_of_each_url_stays(spark, tmp_path):
    source, sink, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    first, seen = {}, set()
    for ids in (range(10, 60), range(0, 80), range(70, 100)):
        batch = [(i, "hot" if i % 2 else f"u{i % 35}", f"html {i}") for i in ids]
        for i, url, html in sorted(batch):
            if url not in seen:
                first.setdefault(url, (i, html))
        seen |= {url for _, url, _ in batch}
        pages = spark.createDataFrame(batch, "page_id bigint, url string, html string")
        pages.repartition(3).write.mode("append").parquet(source)
        start_first_copies(read_page_stream(spark, source), sink, state).awaitTermination()
    got = read_intake(spark, sink).collect()
    assert {r.url: (r.page_id, r.html) for r in got} == first and len(got) == len(first)
