from pyspark.sql import functions as F

from station_telemetry.__main__ import main
from station_telemetry.streaming.feeds import payload_readings
from station_telemetry.sinks.documents import document_table

from test_streams import make_messages


def test_central_ingest_and_views(spark, tmp_path, capsys):
    landed, data = str(tmp_path / "landed"), str(tmp_path / "data")
    make_messages(spark, 0, 300).write.parquet(landed)
    assert main(["central", "--messages", landed, "--data", data, "--once"]) == 0
    assert main(["compact", "--data", data]) == 0

    assert main(["view", "--data", data, "--key", "2"]) == 0
    assert '"sequenceNumber":298' in capsys.readouterr().out
    assert main(["view", "--data", data, "--key", "9"]) == 1
    assert "no station 9" in capsys.readouterr().err

    assert main(["view-all", "--data", data, "--out", str(tmp_path / "export")]) == 0
    assert "3 stations exported" in capsys.readouterr().out

    documents = str(tmp_path / "documents")
    ingest = ["ingest", "--archive", f"{data}/archive", "--documents", documents,
              "--checkpoint", str(tmp_path / "c"), "--once"]
    assert main(ingest) == 0 and main(ingest) == 0
    assert main(["compact", "--documents", documents, "--vacuum"]) == 0
    table = document_table(spark, documents).current()
    assert table.count() == 300 and table.agg(F.count_distinct("doc_id")).first()[0] == 300


def test_central_keeps_what_no_feed_can_use(spark, tmp_path):
    landed, data = str(tmp_path / "landed"), str(tmp_path / "data")
    messages = make_messages(spark, 0, 30)
    key = F.when(F.col("offset") != 4, F.col("key")).alias("key")
    value = F.when(F.col("offset") != 5, F.col("value")).alias("value")
    messages.select(key, value, "offset").write.parquet(landed)
    assert main(["central", "--messages", landed, "--data", data, "--once"]) == 0
    got = {r.offset: (r.key, r.text) for r in spark.read.parquet(f"{data}/rejects").collect()}
    assert set(got) == {4, 5} and got[4][0] is None and '"sequenceNumber"' in got[4][1]
    assert got[5][0] is not None and got[5][1] is None


def test_payloads(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "1.txt").write_text('{"current":{"time":"2024-01-01T10:15"}}\n')
    data = str(tmp_path / "data")
    assert main(["payloads", "--payloads", str(tmp_path / "landed"), "--data", data, "--once"]) == 0
    row = payload_readings(spark, data).first()
    assert (row.stationId, row.sequenceNumber, row.batteryStatus) == (100, 1, "NOT_AVAILABLE")
