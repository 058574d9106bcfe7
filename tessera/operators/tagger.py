"""Word tags in context: a hidden Markov model (TXT1, TXT2).

States are tags.  A token shows the model its *symbol*: the word itself if it
is a listed function word, else a digit class, a suffix class or the open
class; ``.``, ``!``, ``?`` and line breaks show the end of a sentence, which is
a state of its own.  Costs are whole numbers (``-1000 ln p``), so ties and sums
are exact everywhere.

* ``tag_texts`` finds the cheapest tags of a text (Viterbi) in the tasks, over
  Arrow blocks of many texts: no token is joined or shuffled.
* ``fit`` estimates the probabilities from texts without tags: every round is
  one pass that adds up expected counts (forward-backward) in the tasks and
  one small aggregate.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import stored

# Task functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens of a text: words, and the characters that end a sentence.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[.!?\n]"
STOP = "."

# The library's own starting model -----------------------------
TAGS = (STOP, "CC", "CD", "DT", "EX", "IN", "JJ", "JJS", "MD", "NN", "NNS", "PRP", "PRP$", "RB",
        "TO", "VB", "VBD", "VBG", "VBN", "VBP", "VBZ", "WDT", "WP", "WRB")
# Function words and the tags they can have, likeliest first.
FUNCTION_WORDS = {
    "the": "DT", "a": "DT", "an": "DT", "this": "DT", "these": "DT", "those": "DT",
    "that": "IN DT WDT", "and": "CC", "or": "CC", "but": "CC", "of": "IN", "in": "IN",
    "on": "IN RB", "at": "IN", "by": "IN RB", "for": "IN", "with": "IN", "from": "IN",
    "as": "IN RB", "than": "IN", "to": "TO", "is": "VBZ", "are": "VBP", "was": "VBD",
    "were": "VBD", "be": "VB", "been": "VBN", "has": "VBZ", "have": "VBP VB", "had": "VBD VBN",
    "it": "PRP", "he": "PRP", "she": "PRP", "they": "PRP", "we": "PRP", "i": "PRP", "you": "PRP",
    "his": "PRP$", "her": "PRP$ PRP", "their": "PRP$", "not": "RB", "very": "RB", "then": "RB",
    "there": "EX RB", "can": "MD NN", "will": "MD NN", "would": "MD", "should": "MD",
    "who": "WP", "which": "WDT", "when": "WRB", "where": "WRB",
}
# Suffix classes, the first that fits, and their tags.
SUFFIXES = (("ing", "VBG NN JJ"), ("ed", "VBD VBN JJ"), ("ly", "RB JJ"), ("tion", "NN"),
            ("ment", "NN VB"), ("ness", "NN"), ("ble", "JJ"), ("ous", "JJ"), ("ful", "JJ"),
            ("ive", "JJ NN"), ("est", "JJS NN"), ("er", "NN JJ"), ("es", "NNS VBZ"),
            ("s", "NNS VBZ"))
DIGITS, OPEN = "#", "*"
OPEN_TAGS = "NN JJ VB VBP"
# Weights of the listed tags by place, and of neighbours that go together; any
# other pair weighs 1.
PLACE_WEIGHTS = (4, 2, 1, 1)
NEIGHBOURS = {
    STOP: "DT:12 PRP:8 IN:4 NN:4 NNS:3 RB:3", "DT": "NN:24 JJ:12 NNS:6 CD:2", "JJ": "NN:24 NNS:12",
    "JJS": "NN:12", "NN": "IN:12 VBZ:8 VBD:6 .:8 CC:4 MD:3 NN:4", "NNS": "IN:8 VBP:8 .:6 VBD:4 CC:4",
    "PRP": "VBP:10 VBD:10 VBZ:8 MD:6", "PRP$": "NN:20 NNS:8 JJ:6", "IN": "DT:16 NN:6 PRP$:4 JJ:4",
    "TO": "VB:40 DT:6", "MD": "VB:40 RB:6", "RB": "JJ:8 VBN:6 VB:4 RB:2", "VB": "DT:8 IN:5 PRP:3",
    "VBZ": "DT:6 VBN:6 JJ:5 VBG:5 RB:4", "VBP": "DT:6 VBN:6 JJ:5 VBG:5 RB:4",
    "VBD": "DT:6 VBN:6 JJ:4 IN:4 RB:4", "VBG": "DT:6 IN:4 NN:4", "VBN": "IN:8 TO:4 RB:2",
    "CC": "DT:5 NN:5 PRP:4 JJ:3", "CD": "NNS:12 NN:8", "EX": "VBZ:16 VBP:10", "WP": "VBZ:6 VBD:6",
    "WDT": "VBZ:6 MD:4", "WRB": "PRP:8 DT:6",
}
# ---------------------------------------------------------------------------

NEVER = 1_000_000          # cost of what has probability 0
LEAST = 1e-12              # probabilities are at least this while fitting


@dataclass(frozen=True)
class Tagger:
    """``symbols``: name -> indices of its possible tags, in tag order;
    ``step[i, j]``: probability of tag ``j`` after ``i``; ``show[m, j]``: of
    symbol ``m`` in state ``j``."""
    symbols: dict
    step: np.ndarray
    show: np.ndarray
    history: list = field(default_factory=list)      # log likelihood per round

    def costs(self) -> tuple[np.ndarray, np.ndarray]:
        """The probabilities as whole costs."""
        def cost(p):
            with np.errstate(divide="ignore"):
                return np.where(p > 0, np.minimum(np.rint(-1000 * np.log(p)), NEVER), NEVER) \
                    .astype(np.int64)
        return cost(self.step), cost(self.show)


def _symbol_tags() -> dict:
    out = {STOP: STOP, **FUNCTION_WORDS, DIGITS: "CD"}
    out.update({"-" + s: t for s, t in SUFFIXES})
    out[OPEN] = OPEN_TAGS
    return out


def default_tagger() -> Tagger:
    """The starting model: listed tags by place, neighbours by weight."""
    at = {t: i for i, t in enumerate(TAGS)}
    listed = _symbol_tags()
    show = np.zeros((len(listed), len(TAGS)))
    for m, tags in enumerate(listed.values()):
        for place, t in enumerate(tags.split()):
            show[m, at[t]] = PLACE_WEIGHTS[place]
    step = np.ones((len(TAGS), len(TAGS)))
    for a, row in NEIGHBOURS.items():
        for pair in row.split():
            b, weight = pair.split(":")
            step[at[a], at[b]] = int(weight)
    symbols = {name: [int(j) for j in np.flatnonzero(show[m])] for m, name in enumerate(listed)}
    return Tagger(symbols, step / step.sum(1, keepdims=True), show / show.sum(0, keepdims=True))


def tokens_of(text: str) -> Column:
    """Lower-cased words and sentence ends of a text, in order."""
    return F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit(TOKEN_PATTERN), 0)


def symbols_of(words: pa.Array, model: Tagger) -> np.ndarray:
    """The number of every word's symbol."""
    number = {s: i for i, s in enumerate(model.symbols)}
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    out = np.full(len(words), number[OPEN], np.int32)
    for s, _ in reversed(SUFFIXES):            # the first that fits is written last
        fits = pc.ends_with(words, s).to_numpy(zero_copy_only=False) & (length > len(s) + 1)
        out[fits] = number["-" + s]
    digits = pc.match_substring_regex(words, r"\A[0-9]+\z").to_numpy(zero_copy_only=False)
    out[digits] = number[DIGITS]
    listed = {".": number[STOP], "!": number[STOP], "?": number[STOP], "\n": number[STOP]}
    listed.update({w: i for w, i in number.items() if w in FUNCTION_WORDS})
    at = pc.index_in(words, value_set=pa.array(list(listed), words.type)) \
        .fill_null(-1).to_numpy(zero_copy_only=False)
    return np.where(at >= 0, np.array(list(listed.values()), np.int32)[at], out)


SENTENCES = 1 << 16        # texts a task works on at once
BLOCK = 1 << 18            # and at most so many tokens


def blocks(batches, column: int):
    """Cut record batches into (batch, values, first, valid): at most
    ``SENTENCES`` rows and ``BLOCK`` items of the lists of column number
    ``column`` (one longer list is a block of its own), all items of the block,
    the place of every list's first and the end, and which lists are not null."""
    for b in batches:
        lists = b.column(column)
        ends = np.concatenate([[0], np.cumsum(
            lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))])
        values, valid = lists.flatten(), lists.is_valid().to_numpy(zero_copy_only=False)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK, "right")) - 1)
            hi = min(hi, lo + SENTENCES)
            yield (b.slice(lo, hi - lo), values.slice(ends[lo], ends[hi] - ends[lo]),
                   ends[lo:hi + 1] - ends[lo], valid[lo:hi])
            lo = hi


def tag_places(show: np.ndarray) -> np.ndarray:
    """(symbol, place): the tags a symbol can have, in order, -1 beyond; the
    last row is the start, which has the tag of a sentence end."""
    allowed = [np.flatnonzero(r > 0) for r in show] + [np.zeros(1, np.int64)]
    out = np.full((len(allowed), max(map(len, allowed))), -1)
    for m, tags in enumerate(allowed):
        out[m, :len(tags)] = tags
    return out


def stretches(x: np.ndarray, begins: np.ndarray, places: np.ndarray):
    """Cuts symbols after those with a single tag, where what follows depends
    on nothing before, and where ``begins`` says so.  Returns the symbol before
    each, the stretches' places in order of falling length, and how many of
    them are longer than 0, 1, 2, ..."""
    before = np.concatenate([[0], x[:-1]])
    before[begins] = len(places) - 1
    single = (places >= 0).sum(1) == 1
    starts = np.flatnonzero(begins | single[before])
    length = np.diff(np.append(starts, len(x)))
    order = np.argsort(-length, kind="stable")
    longer = len(length) - np.cumsum(np.bincount(length))
    return before, starts[order], longer[:-1]


def distinct_stretches(x: np.ndarray, before: np.ndarray, starts: np.ndarray, longer: np.ndarray,
                       base: int):
    """Equal short stretches once.  Returns the places in ``x`` of those that
    stay, in a row, ``starts`` and ``longer`` over that row, and how many each
    of its places stands for.  Stretches whose symbols do not fit in one whole
    number all stay."""
    fits = int(63 / np.log2(base)) - 1
    key, length = before[starts].astype(np.int64) + 1, np.zeros(len(starts), np.int64)
    for t, n in enumerate(longer):
        length[:n] += 1
        if t < fits:
            key[:n] = key[:n] * base + x[starts[:n] + t] + 1
    many = int(longer[fits]) if len(longer) > fits else 0
    _, one, times = np.unique(key[many:], return_index=True, return_counts=True)
    kept = np.concatenate([np.arange(many), many + one[::-1]])       # longer ones have larger keys
    times = np.concatenate([np.ones(many, np.int64), times[::-1]])
    length = length[kept]
    row = np.cumsum(length) - length
    at = np.repeat(starts[kept] - row, length) + np.arange(length.sum())
    return at, row, len(length) - np.cumsum(np.bincount(length))[:-1], np.repeat(times, length)


def cheapest(x: np.ndarray, begins: np.ndarray, model: Tagger) -> np.ndarray:
    """The cheapest tag numbers of symbols (Viterbi); ``begins`` marks those
    before which a sentence ended.  All stretches go ahead together, a symbol
    a step; equal costs go to the earlier tag."""
    never = 1 << 55                            # beyond all sums of costs
    step, show = model.costs()
    places = tag_places(model.show)
    known = places >= 0
    shown = np.where(known[:-1], np.take_along_axis(show, np.maximum(places[:-1], 0), 1), never)
    cost = step[places[:, :, None, None], places[None, None, :-1]] + shown[None, None]
    # (before, symbol) in one number, place, place
    cost = np.ascontiguousarray(cost.transpose(0, 2, 1, 3)).reshape(-1, *cost.shape[1::2])
    before, starts, longer = stretches(x, begins, places)
    pair = before.astype(np.int64) * (len(places) - 1) + x
    back = np.zeros((len(x), places.shape[1]), np.uint8)
    at = np.zeros(len(x), np.uint8)
    now = np.where(np.arange(places.shape[1]) > 0, never, 0)[None].repeat(len(starts), 0)
    for t, n in enumerate(longer):
        here = starts[:n] + t
        ways = cost.take(pair[here], 0)
        ways += now[:n, :, None]
        now, best = ways[:, 0], np.zeros(ways[:, 0].shape, np.uint8)
        for i in range(1, ways.shape[1]):
            best[ways[:, i] < now] = i         # equal costs: the earlier tag
            now = np.minimum(now, ways[:, i])
        back[here] = best
        done = longer[t + 1] if t + 1 < len(longer) else 0
        at[here[done:]] = now[done:].argmin(1)
    for t in range(len(longer) - 1, 0, -1):
        here = starts[:longer[t]] + t
        at[here - 1] = back[here, at[here]]
    return places[x, at]


def _tagged(batches, column: int, model: Tagger):
    """(batch, words, codes, first, valid, tags) of every block: its distinct
    words, the code and tag of every token, and its lists as in ``blocks``."""
    for b, tokens, first, valid in blocks(batches, column):
        coded = tokens.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        x = symbols_of(coded.dictionary, model)[codes]
        begins = np.zeros(len(x) + 1, bool)
        begins[first] = True
        tags = cheapest(x, begins[:-1], model) if len(x) else np.zeros(0, np.int64)
        yield b, coded.dictionary, codes, first, valid, tags


def _with_tokens(df: DataFrame, text: str, keep) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in keep], tokens_of(text).alias("_tokens"))


def _fields(rows: DataFrame, keep, *more: StructField) -> StructType:
    return StructType([*rows.schema.fields[:len(keep)], *more])


def _batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=list(names))


def tag_texts(df: DataFrame, text: str, model: Tagger | None = None, keep=(),
              out: str = "tagged") -> DataFrame:
    """``keep`` and ``out``: the words of every text with their tags in
    context, in order, as an array of (token, tag).  Null for a null text,
    empty for one without words."""
    model = model or default_tagger()
    rows, k = _with_tokens(df, text, keep), len(keep)
    pair = StructType([StructField("token", StringType()), StructField("tag", StringType())])

    def run(batches):
        names = pa.array(TAGS)
        for b, words, codes, first, valid, tags in _tagged(batches, k, model):
            shown = tags != TAGS.index(STOP)
            ends = np.concatenate([[0], np.cumsum(shown)])[first]
            pairs = pa.StructArray.from_arrays(
                [words.take(pa.array(codes[shown])), names.take(pa.array(tags[shown]))], ["token", "tag"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, mask=pa.array(~valid))
            yield _batch([*b.columns[:k], lists], [*keep, out])
    return rows.mapInArrow(run, _fields(rows, keep, StructField(out, ArrayType(pair))))


def tag_words(df: DataFrame, text: str, model: Tagger | None = None, keep=()) -> DataFrame:
    """``keep``, ``pos``, ``token`` and ``tag``: a row per word."""
    model = model or default_tagger()
    rows, k = _with_tokens(df, text, keep), len(keep)

    def run(batches):
        names = pa.array(TAGS)
        for b, words, codes, first, _, tags in _tagged(batches, k, model):
            shown = tags != TAGS.index(STOP)
            ends = np.concatenate([[0], np.cumsum(shown)])[first]
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))
            pos = (np.arange(len(row)) - ends[row]).astype(np.int32)
            yield _batch([*(c.take(pa.array(row)) for c in b.columns[:k]), pa.array(pos),
                          words.take(pa.array(codes[shown])), names.take(pa.array(tags[shown]))],
                         [*keep, "pos", "token", "tag"])
    return rows.mapInArrow(run, _fields(rows, keep, StructField("pos", IntegerType()),
                                        StructField("token", StringType()), StructField("tag", StringType())))


def tag_counts(df: DataFrame, text: str, model: Tagger | None = None) -> DataFrame:
    """(token, tag, n) over all texts: a word counts under every tag it has
    somewhere.  Counts are merged block by block in the tasks, then before
    they shuffle."""
    model = model or default_tagger()

    def run(batches):
        names = pa.array(TAGS)
        for _, words, codes, _, _, tags in _tagged(batches, 0, model):
            seen = np.bincount(codes.astype(np.int64) * len(TAGS) + tags)
            found = np.flatnonzero(seen)
            found = found[found % len(TAGS) != TAGS.index(STOP)]
            yield _batch([words.take(pa.array(found // len(TAGS))), names.take(pa.array(found % len(TAGS))),
                          pa.array(seen[found])], ["token", "tag", "n"])
    return (_with_tokens(df, text, ()).mapInArrow(run, "token string, tag string, n long")
            .groupBy("token", "tag").agg(F.sum("n").alias("n")))


# --- estimation -------------------------------------------------------------

def expected(sentences: list, step: np.ndarray, show: np.ndarray):
    """Expected counts of sentences of one length under the model.

    ``sentences`` is an array (sentence, place) of symbol numbers; a sentence
    starts in the state of a sentence end.  Returns the expected steps (from,
    to), the expected (symbol, tag) counts and the log likelihood."""
    x = np.asarray(sentences)
    sums = Expectations(step, show)
    sums.add(x.ravel(), np.arange(x.size) % x.shape[1] == 0)
    return sums.totals()


class Expectations:
    """Adds up the expected counts of symbols, by neighbours: how often symbol
    ``m`` in its ``i``-th tag is followed by symbol ``l`` in its ``j``-th."""

    def __init__(self, step: np.ndarray, show: np.ndarray):
        self.shape = step.shape, show.shape
        self.places = p = tag_places(show)
        known = p >= 0
        shown = np.where(known[:-1], np.take_along_axis(show, np.maximum(p[:-1], 0), 1), 0.0)
        chance = step[p[:, :, None, None], p[None, None, :-1]] * known[:, :, None, None] * shown[None, None]
        # (before, symbol) in one number, place, place
        self.chance = np.ascontiguousarray(chance.transpose(0, 2, 1, 3)).reshape(-1, p.shape[1], p.shape[1])
        self.pairs, self.like = np.zeros_like(self.chance), 0.0

    def add(self, x: np.ndarray, begins: np.ndarray):
        """Forward and backward over symbols, all stretches together;
        ``begins`` marks those before which a sentence ended."""
        k = self.places.shape[1]
        before, starts, longer = stretches(x, begins, self.places)
        at, starts, longer, times = distinct_stretches(x, before, starts, longer, len(self.places) + 1)
        pair = before[at].astype(np.int64) * (len(self.places) - 1) + x[at]
        past, scale, ahead = np.zeros((len(at), k)), np.zeros(len(at)), np.zeros((len(at), k))
        now = np.eye(1, k).repeat(len(starts), 0)
        for t, n in enumerate(longer):
            here = starts[:n] + t
            past[here] = now[:n]
            now = np.einsum("ni,nij->nj", now[:n], self.chance.take(pair[here], 0))
            size = np.maximum(np.einsum("nj->n", now), 1e-300)
            scale[here] = size
            now /= size[:, None]
        after = np.ones((len(starts), k))
        for t in range(len(longer) - 1, -1, -1):
            n = longer[t]
            here = starts[:n] + t
            ahead[here] = right = after[:n] / scale[here][:, None]
            after[:n] = np.einsum("nij,nj->ni", self.chance.take(pair[here], 0), right)
        order = np.argsort(pair, kind="stable")
        found, first = np.unique(pair[order], return_index=True)
        past *= times[:, None]
        both = past.take(order, 0)[:, :, None] * ahead.take(order, 0)[:, None, :]
        self.pairs[found] += np.add.reduceat(both, first, 0) * self.chance[found]
        self.like += float((times * np.log(scale)).sum())

    def totals(self):
        """Expected steps, expected (symbol, tag) counts, log likelihood."""
        steps, shown = np.zeros(self.shape[0]), np.zeros(self.shape[1])
        k, n = self.places.shape[1], len(self.places) - 1
        found = np.argwhere(self.pairs > 0)
        values = self.pairs[tuple(found.T)]
        here, now = found[:, 0] % n, self.places[found[:, 0] % n, found[:, 2]]
        np.add.at(steps, (self.places[found[:, 0] // n, found[:, 1]], now), values)
        np.add.at(shown, (here, now), values)
        return steps, shown, self.like


def expected_counts(symbols: DataFrame, model: Tagger) -> DataFrame:
    """(kind, i, j, value): expected steps (kind 0), expected (symbol, tag)
    counts (1) and the log likelihood (2) over all texts; ``symbols`` has an
    array ``s`` per text.  One partial sum per task, merged by one aggregate."""
    step, show = model.step, model.show

    def run(batches):
        sums = Expectations(step, show)
        for _, values, first, _ in blocks(batches, 0):
            x = values.to_numpy(zero_copy_only=False)
            begins = np.zeros(len(x) + 1, bool)
            begins[first] = True
            begins[1:][x == 0] = True
            if len(x):
                sums.add(x, begins[:-1])
        steps, shown, like = sums.totals()
        rows = [(0, i, j, v) for (i, j), v in np.ndenumerate(steps) if v]
        rows += [(1, i, j, v) for (i, j), v in np.ndenumerate(shown) if v]
        rows.append((2, 0, 0, like))
        cols = list(zip(*rows))
        yield _batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
                     ["kind", "i", "j", "value"])

    return (symbols.select("s").mapInArrow(run, "kind int, i int, j int, value double")
            .groupBy("kind", "i", "j").agg(F.sum("value").alias("value")))


def symbol_table(df: DataFrame, text: str, model: Tagger) -> DataFrame:
    """The symbols of every text (``s``), written once for all rounds."""
    def run(batches):
        for b, tokens, first, valid in blocks(batches, 0):
            coded = tokens.dictionary_encode()
            x = symbols_of(coded.dictionary, model)[coded.indices.to_numpy(zero_copy_only=False)]
            yield _batch([pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32()),
                                                   mask=pa.array(~valid))], ["s"])
    return stored(_with_tokens(df, text, ()).mapInArrow(run, "s array<int>"), "symbols")


def fit(df: DataFrame, text: str, rounds: int = 5, model: Tagger | None = None,
        symbols: DataFrame | None = None) -> Tagger:
    """The model after ``rounds`` of expectation and maximisation over all
    texts.  What a round brings to the driver has the size of the model (tags
    x tags + symbols x tags numbers); tags a symbol cannot have stay out.
    ``history`` holds the log likelihood before every round, which never
    falls.  Without any word the model stays as it is.  ``symbols`` is the
    texts' ``symbol_table`` if there is one already: it is the same for all
    models with these symbols."""
    model = model or default_tagger()
    symbols = symbol_table(df, text, model) if symbols is None else symbols
    for _ in range(rounds):
        step, show, like = np.zeros_like(model.step), np.zeros_like(model.show), 0.0
        for r in expected_counts(symbols, model).collect():
            if r["kind"] == 2:
                like = r["value"]
            else:
                (step if r["kind"] == 0 else show)[r["i"], r["j"]] = r["value"]

        def shares(counts, old, axis):
            total = counts.sum(axis, keepdims=True)
            new = np.where(total > 0, counts / np.where(total > 0, total, 1), old)
            return np.where(old > 0, np.maximum(new, LEAST), 0.0)
        model = Tagger(model.symbols, shares(step, model.step, 1), shares(show, model.show, 0),
                       [*model.history, like])
    return model
