"""Token counts for a piece vocabulary with byte fallback (operator 2).

Whole-token shortcut: most words of a corpus are vocabulary strings that
encode alone as one token.  Which ones is proven once, without any text, by
running the merge procedure on every vocabulary string.  A text is cut at
places no vocabulary string crosses; the parts found in the proven set count
one token each, and only the rest is merged.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, lean, tokenizer_path

SPACE = "▁"           # the vocabulary's visible blank
CACHE = 400_000            # merged parts a worker remembers
SHORT = 64                 # parts up to so many characters are merged without a heap
LINE_CHARS = "\n\r\t"


def load_ranks(path: str) -> dict[str, float]:
    """Normal pieces and their scores (no control, unknown or byte pieces)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}


def merge_count(part: str, ranks: dict[str, float]) -> int:
    """Tokens of ``part`` after the merges: the best-scored neighbouring pair
    first, the leftmost of equals; characters without a piece count their
    UTF-8 bytes."""
    if len(part) > SHORT:
        return _merge_long(part, ranks)
    none, get = float("-inf"), ranks.get
    sym = list(part)
    pairs = [get(part[i:i + 2], none) for i in range(len(part) - 1)]
    while pairs and (best := max(pairs)) > none:
        i = pairs.index(best)
        sym[i:i + 2] = [sym[i] + sym[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(sym[i] + sym[i + 1], none)
        if i:
            pairs[i - 1] = get(sym[i - 1] + sym[i], none)
    return sum(1 if s in ranks else len(s.encode("utf-8")) for s in sym)


def _merge_long(part: str, ranks: dict[str, float]) -> int:
    """The same merges with a heap: n log n for texts without any break."""
    n = len(part)
    end = list(range(1, n + 1))                # symbol i spans i to end[i]
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(-s, i, i + 2) for i in range(n - 1) if (s := ranks.get(part[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i):
        j = end[i]
        if j < n and (s := ranks.get(part[i:end[j]])) is not None:
            heapq.heappush(heap, (-s, i, end[j]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    symbols = (part[i:end[i]] for i in range(n) if alive[i])
    return sum(1 if s in ranks else len(s.encode("utf-8")) for s in symbols)


@dataclass(frozen=True)
class Shortcut:
    """What the vocabulary alone proves."""

    ranks: dict            # piece -> score
    whole: frozenset       # pieces that encode alone as one token
    cut: str               # line characters that occur in no longer piece
    blanks_lead: bool      # no piece holds a blank after another character


def prove(ranks: dict[str, float]) -> Shortcut:
    whole = frozenset(p for p in ranks if merge_count(p, ranks) == 1)
    joined = {c for p in ranks if len(p) > 1 for c in p}
    lead = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ranks)
    return Shortcut(ranks, whole, "".join(c for c in LINE_CHARS if c not in joined), lead)


def splitter(s: Shortcut) -> re.Pattern:
    """Parts between which no merge is possible: a run of blanks with the word
    behind it, and the line characters proven never to merge."""
    if not s.blanks_lead:                       # nothing is proven: the whole text is one part
        return re.compile("(?s).+")
    cut = re.escape(s.cut)
    return re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" + (f"|[{cut}]" if cut else ""))


def count_tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 vocabulary: str | None = None, limit: int = 4096) -> DataFrame:
    """Token count of every whole text.

    Returns the columns ``keep`` (under their names, even if ``df`` has others
    called ``n_tokens`` and so on) with ``n_bytes`` (UTF-8), ``n_tokens``,
    ``n_direct`` (tokens counted by the shortcut) and ``over_limit``
    (``n_tokens > limit``).  A null text counts as empty: 0 bytes, 0 tokens.
    One output row per input row, repeated rows included; map-only, texts of
    any length, an empty table gives an empty result.
    """
    ranks = load_ranks(vocabulary or tokenizer_path("piece_bpe_32k.model"))
    s = prove(ranks)
    find = splitter(s).findall
    proven = df.sparkSession.sparkContext.broadcast((s.ranks, s.whole))  # fixed by the vocabulary
    inner = df.select(F.coalesce(F.col(text), F.lit("")).alias("__text"),
                      *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
    kept = inner.schema.fields[1:]

    def run(batches):
        ranks, whole = proven.value
        cache = {}

        def count(t: str) -> tuple[int, int]:
            if not t:
                return 0, 0
            direct = rest = 0
            for p, k in Counter(find(SPACE + t.replace(" ", SPACE))).items():
                if p in whole:
                    direct += k
                    continue
                n = cache.get(p)
                if n is None:
                    n = merge_count(p, ranks)
                    if len(cache) >= CACHE:
                        cache.clear()
                    if len(p) <= 64:
                        cache[p] = n
                rest += k * n
            return direct, direct + rest

        for b in byte_blocks(batches, 0):
            col = b.column(0)
            pairs = [count(t) for t in col.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([d for d, _ in pairs], pa.int64()),
                 pa.array([n for _, n in pairs], pa.int64()),
                 pa.compute.binary_length(col).cast(pa.int64())],
                names=[*b.schema.names[1:], "__direct", "__tokens", "__bytes"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept),
                        "__direct long", "__tokens long", "__bytes long"])
    out = inner.mapInArrow(lean(run), schema)
    return out.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
                      F.col("__bytes").alias("n_bytes"), F.col("__tokens").alias("n_tokens"),
                      (F.col("__tokens") > limit).alias("over_limit"),
                      F.col("__direct").alias("n_direct"))
