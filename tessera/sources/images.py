"""Image files as float arrays (SRC4, PRJ5): decoded by Spark's image source,
resized and scaled with array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNELS = 3


def read_labelled_images(spark: SparkSession, root: str, height: int, width: int, glob: str = "*",
                         scale: float = 1 / 255, drop_invalid: bool = True) -> DataFrame:
    """Every image under ``root/<label>/…``: ``path, label, height, width``
    (of the file) and ``pixels``, an ``array<float>`` of ``height * width * 3``
    numbers by row, column and colour (red, green, blue), times ``scale``.

    The image source lists and decodes files in parallel, one a row (an image
    has to fit in a task's memory).  Pixels are taken from the nearest place of
    the file's grid.  Grey images have three equal colours, transparency is
    ignored.  Files that are no image are left out, or with ``drop_invalid``
    off have null size and pixels; Spark skips files of no bytes, and a folder
    of none gives an empty table.  The label is the parent folder name (a ``key=value`` folder gives
    its value)."""
    read = (spark.read.format("image").option("dropInvalid", drop_invalid)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", glob))
    image = F.col("image")
    size = F.when(image.height > 0, image.height), F.when(image.width > 0, image.width)
    folder = F.element_at(F.split(image.origin, "/"), -2)
    return read.load(root).select(
        image.origin.alias("path"), F.regexp_replace(F.url_decode(folder), r"^[^=]*=", "").alias("label"),
        size[0].alias("height"), size[1].alias("width"),
        F.when(size[0].isNotNull(), pixels(image, height, width, scale)).alias("pixels"))


def pixels(image: Column, height: int, width: int, scale: float = 1 / 255) -> Column:
    """The decoded bytes (blue, green, red by place) of an image struct as a
    scaled ``array<float>`` of another size, red first.  Only the places that
    are taken are turned into numbers."""
    def taken(i: Column) -> Column:
        y, x = F.floor(i / (width * CHANNELS)), F.floor(i / CHANNELS) % width
        row = F.floor((y + 0.5) * image.height / height)
        col = F.floor((x + 0.5) * image.width / width)
        colour = F.least(F.lit(CHANNELS - 1) - i % CHANNELS, image.nChannels - 1)
        at = (row * image.width + col) * image.nChannels + colour
        byte = F.decode(F.substring(image.data, (at + 1).cast("int"), F.lit(1)), "ISO-8859-1")
        return (F.ascii(byte) * F.lit(scale)).cast("float")

    return F.transform(F.sequence(F.lit(0), F.lit(height * width * CHANNELS - 1)), taken)


def bitmap(data: Column, height: int, width: int) -> Column:
    """An uncompressed 24-bit bitmap file from ``height * width * 3`` bytes
    (blue, green, red; last row first), as binary.  Rows of the format end at
    four bytes, so ``3 * width`` has to be a multiple of 4."""
    if width * CHANNELS % 4:
        raise ValueError("3 * width must be a multiple of 4")
    body = height * width * CHANNELS
    header = b"BM" + b"".join(n.to_bytes(size, "little") for n, size in (
        (54 + body, 4), (0, 4), (54, 4),                               # file size, place of the body
        (40, 4), (width, 4), (height, 4), (1, 2), (CHANNELS * 8, 2),   # second header, planes, bits
        (0, 4), (body, 4), (0, 4), (0, 4), (0, 4), (0, 4)))
    return F.concat(F.lit(header), data)


def write_labelled_files(df: DataFrame, content: str, label: str, path: str) -> None:
    """One file per row with the bytes of ``content`` under ``path/label=…``.
    Spark's text writer writes them as they are, and one line break after
    them, which image formats with a stated size ignore."""
    raw = df.select(F.col(label).alias("label"), F.col(content).cast("string").alias("value"))
    raw.write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("label").text(path)
