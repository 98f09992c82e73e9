"""All jobs in a row, through files."""

import base64
import io
import json
import tarfile
import zlib

from whosaid.operators.metrics import RunMetrics
from whosaid.plans.extract import extract_articles
from whosaid.plans.ingest import ingest_archives
from whosaid.plans.mapping import map_discarded
from whosaid.plans.tagging import tag_corpus
from whosaid.sources.scans import scan_articles, scan_attributions, scan_mapping
from whosaid.sources.sinks import write_json, write_parquet

SAID = "we will never leave this town again, whatever happens"
TOLD = "nobody told us that the well-known bridge was closed"


def page(number, said):
    return (
        f"<html><head><title>t{number}</title></head><body><div>The mayor <b>s</b>aid: "
        f"“{said}” <script>var q = '“';</script>in town hall {number}.</div></body></html>"
    )


def archive(path, records):
    lines = "\n".join(map(json.dumps, records)).encode()
    with tarfile.open(path, "w:gz") as out:
        info = tarfile.TarInfo("feed/records.json")
        info.size = len(lines)
        out.addfile(info, io.BytesIO(lines))


def record(number, html, kind="NEWS"):
    data = base64.b64encode(zlib.compress(html.encode())).decode()
    payload = {"encoding": "zlib", "data": data}
    link = {"href": f"http://e.org/{number}"}
    return {
        "source": {"publisherType": kind},
        "feedEntry": {"identifier": number, "canonicalLink": link},
        "permalinkEntry": {
            "identifier": number,
            "canonicalLink": link,
            "contentExtract": payload,
        },
    }


def test_from_archives_to_tables(spark, tmp_path):
    archive(
        tmp_path / "a.tar.gz",
        [record(i, page(i, SAID if i % 2 else TOLD)) for i in range(1, 11)],
    )
    archive(
        tmp_path / "b.tar.gz",
        [record(20, page(1, SAID)), record(21, page(2, TOLD)), record(22, "x", "BLOG")],
    )
    run = RunMetrics()
    entries = ingest_archives(
        spark, f"{tmp_path}/*.tar.gz", types=["NEWS"], dedupe=True
    )
    write_json(run.watch(entries), f"{tmp_path}/dataset", codec="GzipCodec")
    assert run.report()["documents"] == 10

    articles = scan_articles(spark, f"{tmp_path}/dataset/*.gz")
    write_parquet(tag_corpus(articles), f"{tmp_path}/tagged")
    tagged = {r.articleUID: r for r in spark.read.parquet(f"{tmp_path}/tagged").collect()}
    assert set(tagged) == {str(i) for i in range(1, 11)}
    assert tagged["2"].content == (
        "The mayor said : <INPUT_QUOTATION> in town hall 2 .".split()
    )
    assert tagged["2"].quotation == TOLD.replace("-", " - ").split()

    (tmp_path / "attributions.json").write_text(
        json.dumps(
            {
                "speaker": "Mayor",
                "canonicalQuotation": TOLD,
                "occurrences": [
                    {"articleUID": uid, "quotation": TOLD, "extractedBy": "said", "patternConfidence": 0.7}
                    for uid in ("2", "4", "99")
                ],
            }
        )
    )
    attributions = scan_attributions(spark, f"{tmp_path}/attributions.json")
    extracted = extract_articles(articles, attributions).collect()
    assert sorted(r.articleUID for r in extracted) == ["2", "4"]
    assert {r.speaker for r in extracted} == {"Mayor"}
    assert extracted[0].quotation == TOLD.replace("-", " - ").split()

    (tmp_path / "mapping.json").write_text(
        "\n".join(
            json.dumps(
                {
                    "articleUID": uid,
                    "canonicalQuotationDestination": TOLD,
                    "canonicalQuotationSource": "the well-known bridge",
                    "confidence": 0.1 * uid,
                }
            )
            for uid in (6, 6, 8, 77)
        )
    )
    mapping = scan_mapping(spark, f"{tmp_path}/mapping.json")
    mapped = map_discarded(articles, attributions, mapping).collect()
    assert sorted(r.articleUID for r in mapped) == [6, 8]
    assert {tuple(r.quotation) for r in mapped} == {
        ("the", "well", "-", "known", "bridge")
    }
    assert mapped[0].content[:3] == ["The", "mayor", "said"]
