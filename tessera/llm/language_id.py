"""Language identification by compression (operator 7).

Every language gets a raw-content zstandard dictionary made of training
excerpts.  A text, in lower case and without punctuation and digits, is cut
into windows, every window is compressed with each dictionary, and the language
with the smallest total wins.  Where the two best totals lie close, the text is
compressed again at a level that searches harder; if they still lie closer than
a margin, the text is rejected.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, extended, lean

#: Bounds of the training sample: excerpts per language and their length.
#: 120 excerpts of 1,000 characters fill a dictionary of about 120 KB.
EXCERPTS = 120
EXCERPT_CHARS = 1000
MAX_LANGUAGES = 500        # dictionaries stay under 100 MB; more labels raise an error
WINDOW_BYTES = 4096        # so that the dictionary matters along the whole text
LEVEL, HARD_LEVEL = 3, 19
CLOSE = 0.05               # distance under which the harder level decides
MARGIN = 0.01              # least relative distance between the two best totals
UNKNOWN = "und"


def fold(doc_id: Column) -> Column:
    """Fold 0 is held out: ``crc32(doc_id as text) mod 5``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def train(df: DataFrame, text: str = "text", lang: str = "lang",
          excerpts: int = EXCERPTS, excerpt_chars: int = EXCERPT_CHARS) -> dict[str, bytes]:
    """Dictionary content per language from a bounded sample of labelled rows.

    The sample is drawn by the hash of the text, so copies are drawn together
    and count once; per language the ``excerpts`` smallest hashes are kept and
    of each text one excerpt of ``excerpt_chars`` characters at a place given
    by the hash.  Rows with a null or empty text or a null label are no
    training rows; without any the result is empty.  The languages come in
    the order of their number of texts, the most frequent first.
    """
    rows = (df.where(F.col(lang).isNotNull() & (F.length(text) > 0))
            .select(F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.col(text).alias("t")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    if not sizes:
        return {}
    spread = 1 << 30

    def sampled(factor):
        """(lang, h, excerpt) of about factor x excerpts texts a language."""
        keep = F.lit(False)
        for name, n in sizes.items():
            share = min(spread, int(spread * factor * excerpts / max(n, 1)) + 1)
            keep = keep | ((F.col("lang") == name) & (F.pmod("h", F.lit(spread)) < share))
        start = F.pmod(F.shiftrightunsigned("h", 8),
                       F.greatest(F.length("t") - excerpt_chars + 1, F.lit(1)))
        return (rows.where(keep)
                .select("lang", "h", F.substring("t", (start + 1).cast("int"),
                                                 F.lit(excerpt_chars)).alias("e"))
                .groupBy("lang", "h").agg(F.min("e").alias("e")))

    picked = sampled(4).collect()              # bounded: languages x about 4 x excerpts
    out: dict[str, list] = {name: [] for name in sizes}
    for r in sorted(picked, key=lambda r: (r.lang, r.h & (spread - 1), r.h)):
        if len(out[r.lang]) < excerpts:
            out[r.lang].append(r.e)
    ranked = sorted(out, key=lambda name: (-sizes[name], name))
    return {name: prepared("\n".join(reversed(out[name]))) for name in ranked if out[name]}


#: ASCII characters that tell nothing about a language, and line ends as blanks.
_DROPPED = bytes(b for b in range(33, 128) if not chr(b).isalpha())
_BLANKS = bytes(32 if b < 33 else b for b in range(256))


def prepared(text: str) -> bytes:
    return text.lower().encode("utf-8").translate(_BLANKS, _DROPPED)


def windows(data: bytes, size: int = WINDOW_BYTES):
    return (data[i:i + size] for i in range(0, len(data), size))


def classifier(dictionaries: dict[str, bytes], margin: float = MARGIN):
    """Function of a text: (language, score, rejected)."""
    import regex
    import zstandard
    letter = regex.compile(r"\p{L}").search
    names = list(dictionaries)

    def packers(level):
        out = []
        for name in names:
            d = zstandard.ZstdCompressionDict(dictionaries[name],
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False,
                                                write_checksum=False).compress)
        return out
    fast, hard = packers(LEVEL), packers(HARD_LEVEL)

    def best(parts, pack):
        """(place of the best language, relative distance to the second)."""
        totals = [sum(len(p(part)) for part in parts) for p in pack]
        order = sorted(range(len(names)), key=lambda i: (totals[i], i))
        second = totals[order[1]]
        return order[0], (second - totals[order[0]]) / second

    def predict(text: str | None) -> tuple[str, float, bool]:
        if not names or text is None or not letter(text):
            return UNKNOWN, 0.0, True
        if len(names) == 1:
            return names[0], 1.0, False
        parts = list(windows(prepared(text))) or [b""]
        i, gap = best(parts, fast)
        if gap < CLOSE:
            i, gap = best(parts, hard)
        return names[i], gap / (gap + margin) if gap else 0.0, gap < margin

    return predict


def identify(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             margin: float = MARGIN, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")
             ) -> DataFrame:
    """``df`` with the predicted language, a score from 0 to 1 and whether the
    prediction is rejected (null text, no letter, or a margin under
    ``margin``); a column of ``df`` with one of these names is replaced.

    Only the text is read.  ``und`` with score 0 stands for null texts and
    texts without a letter, and for every text when nothing was learned; ties
    go to the most frequent training language, with score 0.  Map-only; the
    dictionaries are bounded by the training sample.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(dictionaries)
    rest = [c for c in df.columns if c not in names]
    inner = df.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(text)

    def run(batches):
        predict = classifier(shared.value, margin)
        for b in byte_blocks(batches, at):
            got = [predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())],
                names=[*b.schema.names, *names])

    return inner.mapInArrow(lean(run), extended(inner, **dict(zip(names, ("string", "double", "boolean")))))


def held_out(doc_id) -> bool:
    """The fold rule in plain Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
