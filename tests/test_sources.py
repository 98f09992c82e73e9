import base64
import gzip
import io
import json
import subprocess
import sys
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from whosaid.functions.payload import inflate_content
from whosaid.operators.metrics import RunMetrics
from whosaid.plans.ingest import ingest_archives
from whosaid.plans.tagging import tag_corpus
from whosaid.schemas import ENTRY
from whosaid.sources import archives as archives_module
from whosaid.sources.archives import scan_archives
from whosaid.sources.scans import (
    CORRUPT,
    good_rows,
    scan_articles,
    scan_attributions,
    scan_mapping,
)
from whosaid.sources.sinks import stage, work_folder, write_json, write_parquet


def make_archive(path, members):
    with tarfile.open(path, "w:gz") as archive:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
            else:
                info.size = len(data)
            archive.addfile(info, io.BytesIO(data or b""))


@pytest.fixture
def archives(tmp_path):
    make_archive(
        tmp_path / "one.tar.gz",
        [("d", None), ("d/e", None), ("d/e/a.txt", b"first"), ("d/empty", b"")],
    )
    make_archive(tmp_path / "two.tar.gz", [("b.txt", bytes(range(256)) * 5000)])
    make_archive(tmp_path / "none.tar.gz", [("d", None)])
    return tmp_path


@pytest.mark.parametrize("stream", [False, True])
def test_scan_archives(spark, archives, stream):
    df = scan_archives(spark, f"{archives}/*.tar.gz", stream=stream)
    found = {(r.path.rsplit("/")[-1], r.member): bytes(r.data) for r in df.collect()}
    assert found == {
        ("one.tar.gz", "d/e/a.txt"): b"first",
        ("one.tar.gz", "d/empty"): b"",
        ("two.tar.gz", "b.txt"): bytes(range(256)) * 5000,
    }


def test_many_members_come_in_batches(spark, tmp_path):
    make_archive(
        tmp_path / "many.tar.gz", [(f"{i}", str(i).encode()) for i in range(3500)]
    )
    df = scan_archives(spark, str(tmp_path))
    assert df.count() == 3500
    assert df.where(F.decode("data", "UTF-8") != F.col("member")).count() == 0


def test_large_members_come_in_pieces_of_whole_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives_module, "BATCH_BYTES", 1000)
    lines = [f"{i} {'é' * (i % 700)}" for i in range(300)]
    make_archive(
        tmp_path / "a.tar.gz",
        [("a", "\n".join(lines).encode()), ("b", b""), ("c", b"\n"), ("d", b"x")],
    )
    df = scan_archives(spark, str(tmp_path), lines=True)
    pieces = {}
    for row in df.collect():
        pieces.setdefault(row.member, []).append(bytes(row.data).decode())
    assert "".join(pieces["a"]).split("\n") == lines
    assert len(pieces["a"]) > 20
    assert (pieces["c"], pieces["d"], "b" in pieces) == (["\n"], ["x"], False)


def test_a_corrupt_archive_fails(spark, tmp_path):
    (tmp_path / "bad.tar.gz").write_bytes(gzip.compress(b"no tar" * 500)[:-40])
    with pytest.raises(Exception):
        scan_archives(spark, str(tmp_path)).count()


def test_inflate_content(spark):
    text = "Grüße, “who”" * 1000
    good = zlib.compress(text.encode())
    df = spark.createDataFrame(
        [(good, "zlib"), (good, "gzip"), (good, None), (None, "zlib"), (None, "")],
        "d binary, e string",
    )
    got = [r.x for r in df.select(inflate_content(F.col("d"), F.col("e")).alias("x")).collect()]
    assert got == [text, "", "", None, ""]

    bad = spark.createDataFrame([(b"bad", "zlib"), (good, "zlib")], "d binary, e string")
    lenient = inflate_content(F.col("d"), F.col("e"), on_error="null")
    assert [r.x for r in bad.select(lenient.alias("x")).collect()] == [None, text]
    with pytest.raises(Exception):
        bad.select(inflate_content(F.col("d"), F.col("e"))).collect()
    with pytest.raises(ValueError):
        inflate_content(F.col("d"), F.col("e"), on_error="skip")


def test_scan_articles_reads_gzip_and_plain_lines(spark, tmp_path):
    lines = [
        {"feedEntry": {"identifier": str(i), "title": "t"}, "permalinkEntry": {"tokenizedContent": ["a", str(i)]}}
        for i in range(50)
    ]
    text = "\n".join(map(json.dumps, lines)).encode()
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(text))
    (tmp_path / "b.json").write_bytes(text)
    df = scan_articles(spark, str(tmp_path))
    assert df.count() == 100
    assert df.schema.simpleString() == (
        "struct<feedEntry:struct<identifier:string>,"
        "permalinkEntry:struct<tokenizedContent:array<string>>>"
    )
    assert scan_articles(spark, str(tmp_path), partitions=3).rdd.getNumPartitions() == 3
    assert scan_articles(spark, str(tmp_path), ENTRY).first().feedEntry.title == "t"


def test_scan_attributions_and_mapping(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps({"speaker": "s", "canonicalQuotation": "c", "occurrences": [
            {"articleUID": "1", "quotation": "q", "extractedBy": "p", "patternConfidence": 1}]})
    )
    row = scan_attributions(spark, f"{tmp_path}/a.json").first()
    assert row.occurrences[0].patternConfidence == 1.0
    (tmp_path / "m.json.gz").write_bytes(
        gzip.compress(b'{"articleUID": 5, "confidence": 0.25}')
    )
    row = scan_mapping(spark, f"{tmp_path}/m.json.gz").first()
    assert (row.articleUID, row.confidence, row.canonicalQuotationSource) == (5, 0.25, None)


@pytest.mark.parametrize(
    "codec, suffix",
    [
        (None, ".json"),
        ("GzipCodec", ".json.gz"),
        ("gzip", ".json.gz"),
        ("Lz4Codec", ".json.lz4"),
        ("BZip2Codec", ".json.bz2"),
        ("SnappyCodec", ".json.snappy"),
    ],
)
def test_write_json(spark, tmp_path, codec, suffix):
    df = spark.createDataFrame([(1, "<b>&"), (2, None)], "i int, t string")
    path = f"{tmp_path}/out"
    write_json(df, path, codec=codec, partitions=2)
    files = [p.name for p in (tmp_path / "out").glob("part-*")]
    assert 1 <= len(files) <= 2 and all(f.endswith(suffix) for f in files)
    back = spark.read.schema(df.schema).json(path)
    assert sorted(map(tuple, back.collect())) == [(1, "<b>&"), (2, None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_json(df, path)


def test_write_json_leaves_nulls_out(spark, tmp_path):
    df = spark.createDataFrame([(2, None)], "i int, t string")
    write_json(df, f"{tmp_path}/out", partitions=1)
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == '{"i":2}\n'


def test_write_json_in_one_file(spark, tmp_path):
    write_json(spark.range(500).repartition(4), f"{tmp_path}/out", partitions=1)
    (part,) = (tmp_path / "out").glob("part-*")
    assert len(part.read_text().splitlines()) == 500


def test_unknown_codec(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown codec"):
        write_json(spark.range(1), f"{tmp_path}/out", codec="ZipCodec")


def test_write_parquet(spark, tmp_path):
    write_parquet(spark.range(10), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(spark.range(10), f"{tmp_path}/out")


def test_stage_cuts_the_lineage(spark):
    staged = stage(spark.range(100).withColumn("r", F.rand()))
    assert staged.collect() == staged.collect()
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert work_folder(spark) != work_folder(spark)


def test_work_folders_end_with_the_application(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from whosaid.sources.sinks import stage
spark = (SparkSession.builder.master("local[1]")
    .config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
assert stage(spark.range(3)).count() == 3
import glob
assert len(glob.glob("{tmp_path}/shared/whosaid-*/*")) == 1
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True)
    # What is left is Spark's own, empty folder.
    assert not list((tmp_path / "shared").glob("whosaid-*"))


def record(number, text, extract=None, publisher="NEWS"):
    def payload(t):
        data = base64.b64encode(zlib.compress(t.encode())).decode()
        return {"encoding": "zlib", "data": data}

    made = {
        "source": {"publisherType": publisher, "lang": [{"code": "en"}, {"code": "fr"}]},
        "feedEntry": {"identifier": number, "content": payload(text)},
        "permalinkEntry": {
            "identifier": number + 1000,
            "canonicalLink": {"href": "http://e.org/p"},
            "author": [{"name": "A"}, {"name": "B"}],
        },
    }
    if extract is not None:
        made["permalinkEntry"]["contentExtract"] = payload(extract)
    return made


def test_ingest_archives(spark, tmp_path):
    records = [
        record(2, "full", '<p>He said "<b>y</b>es"<script>x</script>'),
        record(1, "other", '<p>He said "yes"'),
        record(3, "none"),
        record(4, "forum", "text", publisher="FORUM"),
    ]
    lines = "\n".join(map(json.dumps, records)) + "\n"
    make_archive(tmp_path / "a.tar.gz", [("d", None), ("d/r.json", lines.encode())])
    glob = f"{tmp_path}/*.tar.gz"

    found = {r.feedEntry.identifier: r for r in ingest_archives(spark, glob).collect()}
    assert set(found) == {"1", "2", "3", "4"}
    said = ["<p>", "He", "said", "``", "yes", "''", "</p>"]
    assert found["2"].permalinkEntry.tokenizedContent == said
    assert found["2"].feedEntry.tokenizedContent == ["full"]
    assert found["3"].permalinkEntry.tokenizedContent == []
    assert found["1"].permalinkEntry.identifier == "1001"
    assert found["1"].permalinkEntry.authorName == "A"
    assert found["1"].source.language == "en"
    assert found["1"].feed.title == ""

    news = ingest_archives(
        spark, glob, stream=True, spread=3, types=["NEWS"], dedupe=True
    )
    assert sorted(r.feedEntry.identifier for r in news.collect()) == ["1", "3"]

    raw = ingest_archives(spark, glob, clean=False, tokenize=False, partitions=2)
    texts = {r.feedEntry.identifier: r.permalinkEntry.tokenizedContent for r in raw.collect()}
    assert texts["1"] == ['<p>He said "yes"']
    assert texts["3"] == []


@pytest.mark.parametrize("clean", [False, True])
def test_ingest_of_a_corrupt_payload(spark, tmp_path, clean):
    bad = record(1, "x")
    bad["feedEntry"]["content"]["data"] = base64.b64encode(b"bad").decode()
    lines = "\n".join(map(json.dumps, [bad, record(2, "good")]))
    make_archive(tmp_path / "a.tar.gz", [("r", lines.encode())])
    glob = f"{tmp_path}/*.tar.gz"
    entries = ingest_archives(spark, glob, clean=clean, on_error="null")
    tokens = {r.feedEntry.identifier: r.feedEntry.tokenizedContent for r in entries.collect()}
    assert tokens == {"1": [], "2": ["good"]}
    with pytest.raises(Exception):
        ingest_archives(spark, glob, clean=clean).collect()
    with pytest.raises(ValueError):
        ingest_archives(spark, glob, clean=clean, on_error="skip")


def test_a_line_that_is_no_json_fails_the_job(spark, tmp_path):
    good = {
        "feedEntry": {"identifier": "1"},
        "permalinkEntry": {"tokenizedContent": ["``", *"abcdefgh", "''"]},
    }
    (tmp_path / "a.json").write_text("{broken\n" + json.dumps(good) + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tag_corpus(scan_articles(spark, str(tmp_path))).collect()


def test_numbers_are_read_bare_and_quoted(spark, tmp_path):
    lines = [
        {"articleUID": 12, "confidence": 0.5},
        {"articleUID": "12", "confidence": "0.5"},
        {"articleUID": "x", "confidence": "y"},
        {},
    ]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, lines)))
    rows = scan_mapping(spark, str(tmp_path)).collect()
    assert [(r.articleUID, r.confidence) for r in rows] == [
        (12, 0.5), (12, 0.5), (None, None), (None, None),
    ]
    assert scan_mapping(spark, str(tmp_path)).schema["articleUID"].dataType.typeName() == "long"


def test_ingest_has_the_declared_schema(spark, tmp_path):
    make_archive(tmp_path / "a.tar.gz", [("r", json.dumps(record(1, "x")).encode())])
    df = ingest_archives(spark, f"{tmp_path}/*.tar.gz")
    declared = spark.createDataFrame([], ENTRY).schema
    assert df.schema.simpleString() == declared.simpleString()


def test_lines_that_are_no_records_are_kept_on_demand(spark, tmp_path):
    good = [{"articleUID": i, "confidence": 0.5, "canonicalQuotationSource": "s"} for i in range(3)]
    lines = [*map(json.dumps, good), '{"articleUID": 7, "conf', "no json", "", '{"articleUID": 8}{']
    (tmp_path / "m.json").write_text("\n".join(lines))
    rows = scan_mapping(spark, str(tmp_path), on_error="keep")
    broken = rows.where(F.col(CORRUPT).isNotNull())
    assert {r[CORRUPT] for r in broken.select(CORRUPT, "articleUID").collect()} >= {lines[3], lines[4]}
    assert all(r.articleUID is None for r in broken.collect() if not r[CORRUPT].endswith("}{"))
    run = RunMetrics()
    kept = good_rows(rows, run).select("articleUID").collect()
    assert {0, 1, 2} <= {r.articleUID for r in kept} <= {0, 1, 2, 8}
    report = run.report()
    assert report["documents"] == len(kept) + report["corrupt"]
    assert CORRUPT not in good_rows(rows, RunMetrics()).columns
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan_mapping(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        scan_mapping(spark, str(tmp_path), on_error="drop")


def test_committed_rows_count_what_is_there(tmp_path):
    """A task that fails at first, and leaves half a file, is counted once."""
    code = f"""
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from whosaid.operators.metrics import RunMetrics, committed_files, committed_rows
from whosaid.sources.sinks import write_json, write_parquet
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "3").getOrCreate())
@F.udf("long")
def fails_at_first(i):
    if i == 77 and TaskContext.get().attemptNumber() == 0:
        raise ValueError("first attempt")
    return i
once = spark.range(0, 300, 1, 3).withColumn("i", fails_at_first("id"))
for name, df in (("before", once.repartition(3, "i")), ("while", once)):
    for form, write in (("json", write_json), ("parquet", write_parquet)):
        path = "{tmp_path}/" + name + form
        run = RunMetrics()
        write(run.watch(df), path)
        assert committed_rows(spark, path, form) == 300
        assert run.report(committed_rows(spark, path, form))["documents"] == 300
        files = {{r.file: r.documents for r in committed_files(spark, path, form).collect()}}
        assert len(files) == 3 and sum(files.values()) == 300
empty = "{tmp_path}/empty"
write_parquet(once.where("id < 0"), empty)
assert committed_rows(spark, empty, "parquet") == 0
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True)


def test_payloads_reach_python_some_at_a_time(tmp_path):
    """Workers that inflate 300 MB of text in one partition hold little of it."""
    code = f"""
import glob, zlib
from pyspark.sql import SparkSession, functions as F
from whosaid.functions.payload import inflate_content
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "2g").getOrCreate())
rows = spark.createDataFrame([(zlib.compress(b"word " * 20_000),)], "data binary")
rows = rows.crossJoin(spark.range(3000)).coalesce(1)
for how in ("fail", "null"):
    text = inflate_content(F.col("data"), F.lit("zlib"), how)
    assert rows.agg(F.sum(F.length(text))).first()[0] == 300_000_000
peaks = []
for path in glob.glob("/proc/[0-9]*/status"):
    try:
        command = open(path.replace("status", "cmdline")).read()
        if "pyspark" in command and "daemon" in command:
            lines = dict(line.split(":", 1) for line in open(path))
            peaks.append(int(lines["VmHWM"].split()[0]) // 1024)
    except (OSError, KeyError):
        pass
print(max(peaks))
spark.stop()
"""
    ran = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True)
    assert int(ran.stdout.split()[-1]) < 250
