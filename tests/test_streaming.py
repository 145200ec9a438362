"""Incremental ingest: barcodes once, late and repeated tickets handled batch by batch."""

import os
import tempfile

from salescast.streaming.ingest import ingest, read_export

SCHEMA = "barcode string, event_name string, created_at string, product_value double, product_is_scanned int"


def land(spark, root, name, rows):
    path = os.path.join(root, name)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("header", True).csv(path)
    return read_export(spark, path, "export")


def test_ingest_keeps_each_barcode_once_and_no_late_ticket_is_lost(spark):
    root = tempfile.mkdtemp(prefix="salescast-ingest-")
    target = os.path.join(root, "out")
    first = [("b1", "ev", "2024-07-01 10:00:00", 10.0, 1), ("b1", "ev", "2024-07-01 11:00:00", 10.0, 0),
             ("b2", "ev", "2024-07-20 10:00:00", 12.0, 1)]
    late = [("b3", "ev", "2024-03-01 10:00:00", 9.0, 1), ("b1", "ev", "2023-07-01 10:00:00", 10.0, 1),
            (None, "ev", "2024-07-02 10:00:00", 5.0, 1), (None, "ev", "2024-07-03 10:00:00", 5.0, 1)]
    assert ingest(land(spark, root, "a", first), target) == 2
    assert ingest(land(spark, root, "b", late), target) == 2
    assert ingest(land(spark, root, "c", late), target) == 0
    rows = spark.read.parquet(target).orderBy("barcode").collect()
    assert [r["barcode"] for r in rows] == [None, "b1", "b2", "b3"]
    assert str(rows[1]["verkoopdatum"]) == "2024-07-01 10:00:00"
