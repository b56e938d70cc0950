"""CSV contract of the archive / delta / history."""

import csv

from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.sources import offers_io as IO


def test_reads_a_standard_csv_writer_file(spark, tmpdir_path):
    p = tmpdir_path / "offres.csv"
    row = {h: "" for h in fixed.OFFER_COLUMNS}
    row.update({"ID": "E000001", "Titre": 'Dev "senior"; remote', "Notes": "line1\nline2", "Dept": "06"})
    with p.open("w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=fixed.OFFER_COLUMNS, delimiter=";")
        w.writeheader()
        w.writerow(row)
    got = IO.read_offers_csv(spark, str(p)).first().asDict()
    assert got["Titre"] == 'Dev "senior"; remote' and got["Notes"] == "line1\nline2" and got["Dept"] == "06"


def test_round_trip_and_header_policy(spark, tmpdir_path):
    df = spark.createDataFrame([("E000002", "Titre; \"q\"", "x")], "ID string, Titre string, extra string")
    root = str(tmpdir_path / "deltas")
    IO.write_dated_delta(df, root, "20260602", "r1")
    IO.write_dated_delta(df, root, "20260602", "r1")    # replay replaces the run
    back = IO.read_dated_delta(spark, f"file://{root}", "20260602").collect()   # a URI reads like the plain path
    assert len(back) == 1 and back[0]["Titre"] == 'Titre; "q"' and back[0]["Traite"] == ""
    assert "extra" not in back[0].asDict()
    assert IO.read_dated_delta(spark, root, "20990101").count() == 0
    IO.write_dated_delta(df.withColumn("ID", F.lit("E000003")), root, "20260602", "r2")
    assert sorted(r["ID"] for r in IO.read_dated_delta(spark, root, "20260602").collect()) == ["E000002", "E000003"]
    IO.write_offers_csv(df, str(tmpdir_path / "bare"), force_headers=False)
    assert [r[0] for r in spark.read.option("sep", ";").csv(str(tmpdir_path / "bare")).select("_c0").collect()] == ["E000002"]


def test_history_and_schema_evolution(spark, tmpdir_path):
    h = spark.createDataFrame([("2026-06-02T10:00:00", 3, 3, 0, 1, 1, False)],
                              "Date_run string, Fichiers_traites long, Offres_extraites long, Doublons long, "
                              "Ignores long, Erreurs long, Dry_run boolean")
    p = str(tmpdir_path / "history")
    IO.append_history_csv(h, p)
    IO.append_history_csv(h, p)
    assert spark.read.option("header", "true").option("sep", ";").csv(p).count() == 2
    old = spark.createDataFrame([("E1",)], "ID string")
    new = IO.add_column_if_missing(old)
    assert new.columns == ["ID", "Message_ID"] and new.first()["Message_ID"] == ""
    kept = IO.add_column_if_missing(spark.createDataFrame([("E1", "<m>")], "ID string, Message_ID string"))
    assert kept.first()["Message_ID"] == "<m>" and IO.add_column_if_missing(kept).columns == kept.columns
