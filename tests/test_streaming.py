"""File-stream loading: availableNow passes load each file once; bad rows go to quarantine."""

import os

from lakeloom.streaming.file_stream import load_available


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode("iso-8859-1"))


def test_available_now_passes(spark, tmp_path):
    landing, bronze, ckpt, quarantine = (str(tmp_path / p) for p in ("in", "bronze", "ckpt", "q"))
    cols = ["CO", "NO"]
    write(f"{landing}/a.csv", "CO;NO\n1;São\n2;\"x;y\"\n3\n")
    load_available(spark, landing, cols, bronze, ckpt, quarantine_path=quarantine)
    assert spark.read.parquet(bronze).count() == 2
    assert spark.read.json(quarantine).count() == 1
    load_available(spark, landing, cols, bronze, ckpt, quarantine_path=quarantine)   # nothing new
    assert spark.read.parquet(bronze).count() == 2
    write(f"{landing}/b.csv", "CO;NO\n4;Ção\n")
    load_available(spark, landing, cols, bronze, ckpt, quarantine_path=quarantine)
    rows = {r["CO"]: r["NO"] for r in spark.read.parquet(bronze).collect()}
    assert rows == {"1": "São", "2": "x;y", "4": "Ção"}
