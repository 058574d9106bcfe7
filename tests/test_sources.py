"""Sources and sinks round trips."""

import os
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import images, io


def test_keyed_records_python_literal(spark, tmp_path):
    p = tmp_path / "cars.txt"
    p.write_text("{'001': {'Brand': 'Perodua', 'Price/day': 'RM120'}, "
                 "'002': {'Brand': 'Proton', 'Price/day': 'RM246'}}")
    df = io.read_keyed_records(spark, str(p), ["Brand", "Price/day"], key="CarID",
                               whole_file=True)
    assert sorted(map(tuple, df.collect())) == [("001", "Perodua", "RM120"), ("002", "Proton", "RM246")]


def test_keyed_records_round_trip(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "b", None)], "id string, f string, g string")
    path = scratch_path(spark, "kr")
    io.write_keyed_records(df, path, "id")
    back = io.read_keyed_records(spark, path, ["f", "g"], key="id")
    assert sorted(map(tuple, back.collect())) == [("1", "a", "x"), ("2", "b", None)]


def test_csv_with_quotes_and_newlines(spark):
    df = spark.createDataFrame([("u1", 'He said "hi",\nthen left', None)],
                               "url string, Review string, Rating string")
    path = scratch_path(spark, "csv")
    io.write_reviews_csv(df, path)
    back = io.read_reviews_csv(spark, path, "url string, Review string, Rating string")
    assert back.collect()[0] == df.collect()[0]


def test_labelled_dir(spark, tmp_path):
    for lab, n in (("drone", 2), ("bird", 1)):
        os.makedirs(tmp_path / lab)
        for i in range(n):
            (tmp_path / lab / f"{i}.bin").write_bytes(b"x" * (i + 1))
    df = io.read_labelled_dir(spark, str(tmp_path), "*.bin")
    assert sorted((r.label, r.length) for r in df.collect()) == [("bird", 1), ("drone", 1), ("drone", 2)]


def test_write_labels_sorted_distinct(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    path = scratch_path(spark, "labels")
    io.write_labels(df, "label", path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a", "b"]


def test_materialize_refuses_another_number_of_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    with pytest.raises(ValueError):
        io.materialize(df, "tmp_short", "A int, B int")


def test_no_machine_local_folder_outside_local(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return type("C", (), {"get": lambda s, k, d=None: d})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda s, k, d=None: d})()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_materialize_declared_types(spark):
    df = spark.createDataFrame([("x", 1.7)], "a string, b double")
    t = io.materialize(df, "tmp_tbl", "A string, B decimal(18,0)")
    assert t.schema.simpleString() == "struct<A:string,B:decimal(18,0)>"
    assert t.first().B == 2 and spark.table("tmp_tbl").count() == 1


def _bitmap_file(pixels) -> bytes:
    """24-bit bitmap of rows of (red, green, blue), by hand."""
    h, w = len(pixels), len(pixels[0])
    body = b"".join(b"".join(bytes((b, g, r)) for r, g, b in row) + b"\0" * (-3 * w % 4)
                    for row in reversed(pixels))
    return struct.pack("<2sIIIIiiHHIIiiII", b"BM", 54 + len(body), 0, 54, 40, w, h, 1, 24, 0,
                       len(body), 0, 0, 0, 0) + body


def _png_file(rows, colour_type) -> bytes:
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    width = len(rows[0]) // {0: 1, 6: 4}[colour_type]
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), 8, colour_type, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + bytes(r) for r in rows))) + chunk(b"IEND", b""))


@pytest.mark.parametrize("height, width", [(3, 5), (6, 2), (1, 1), (7, 11)])
def test_images_are_decoded_and_resized(spark, tmp_path, height, width):
    rng = random.Random(5)
    picture = [[tuple(rng.randrange(256) for _ in range(3)) for _ in range(5)] for _ in range(3)]
    (tmp_path / "label=a bird").mkdir()
    (tmp_path / "label=a bird" / "x.bmp").write_bytes(_bitmap_file(picture))
    r = images.read_labelled_images(spark, str(tmp_path), height, width, "*.bmp").first()
    want = [c / 255 for y in range(height) for x in range(width)
            for c in picture[(2 * y + 1) * 3 // (2 * height)][(2 * x + 1) * 5 // (2 * width)]]
    assert (r.label, r.height, r.width) == ("a bird", 3, 5)
    assert r.pixels == pytest.approx(want, abs=1e-6)


def test_grey_transparent_and_broken_images(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "grey.png").write_bytes(_png_file([[0, 10, 255]], 0))
    (tmp_path / "d" / "clear.png").write_bytes(_png_file([[1, 2, 3, 0, 7, 8, 9, 200]], 6))
    (tmp_path / "d" / "broken.png").write_bytes(b"no image")
    (tmp_path / "d" / "empty.png").write_bytes(b"")
    def read(**kw):
        rows = images.read_labelled_images(spark, str(tmp_path), 1, 3, scale=1.0, **kw).collect()
        return {os.path.basename(r.path): r.pixels for r in rows}
    got = read()
    assert got == {"grey.png": [0] * 3 + [10] * 3 + [255] * 3, "clear.png": [1, 2, 3, 7, 8, 9, 7, 8, 9]}
    assert read(drop_invalid=False) == got | {"broken.png": None}


def test_bitmap_files_have_the_format(spark):
    row = spark.range(1).select(images.bitmap(F.lit(bytes(range(24))), 2, 4).alias("f")).first()
    got = [[(3 * i + 2, 3 * i + 1, 3 * i) for i in range(4 * r, 4 * r + 4)] for r in (1, 0)]
    assert bytes(row.f) == _bitmap_file(got)
    with pytest.raises(ValueError):
        images.bitmap(F.lit(b""), 1, 3)
