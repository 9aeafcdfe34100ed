"""Toxic passages as maximum-scoring segments of token log-odds.

Labelled documents say how much likelier a token is in toxic texts than in
others: log-odds with an informative Dirichlet prior, so that rare tokens need
more to stand out. A token without evidence of its own takes that of its first
letters. In a text, one linear scan finds every maximal segment of scores. What
a segment is worth depends on how high scores rise by chance in a text as long:
an extreme-value distribution, fitted to the best segments of clean texts.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import broadcast_if_small, equip, stored
from larderline.llm.language import fold

# Letters that stand for a token which has no evidence of its own.
STEM = 4
# Weight of the prior, as a share of all counts, and the z-score from which a
# token's log-odds count.
PRIOR_SHARE = 0.1
LEAST_Z = 2.5
# Tokens of a model that tasks hold. More stay a table, and each text gets its own.
MODEL_TOKENS = 200_000

# Chance finds in a text, below which a segment is significant.
MOST_CHANCE_FINDS = 0.05
PREDICTED_FROM = 0.7

# Evidence beyond this no longer changes the calibration.
MOST_EVIDENCE = 100.0
_EULER = 0.5772156649015329

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The runs of letters, lower-cased."""
    return _LETTERS.findall((text or "").lower())


def stem_of(word: str) -> str:
    """How the token of a word's first letters is written."""
    return word[:STEM] + "*"


class Model(NamedTuple):
    """Log-odds by token (None: they are a table), and of any other token; how
    chance scores are spread; and the calibration of the evidence."""

    scores: dict[str, float] | None
    other: float
    scale: float = 1.0
    log_size: float = 0.0
    slope: float = 1.0
    offset: float = 0.0


class Segment(NamedTuple):
    first: int
    last: int
    score: float


def maximal_segments(scores: np.ndarray) -> list[Segment]:
    """All maximal segments of positive total, by place, in linear time.

    Each rising step is a candidate. It joins an earlier one if the total before
    that is lower than before itself, and the total after itself higher than
    after that one. A candidate remembers the last earlier one that began lower,
    so each is passed over once.
    """
    rising = np.flatnonzero(scores > 0)
    if not len(rising):
        return []
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []
    for at in rising.tolist():
        first, low, high = at, float(totals[at]), float(totals[at + 1])
        earlier = len(found) - 1
        while True:
            while earlier >= 0 and found[earlier][2] >= low:
                earlier = found[earlier][4]
            if earlier < 0 or found[earlier][3] >= high:
                break
            first, low = found[earlier][0], found[earlier][2]
            del found[earlier:]
            earlier = len(found) - 1
        found.append((first, at, low, high, earlier))
    return [Segment(first, last, high - low) for first, last, low, high, _ in found]


def segments_of(
    text: str | None, known: dict[str, float], other: float
) -> tuple[int, list[Segment]]:
    """How many words the text has, and its maximal segments."""
    words = words_of(text)

    def score(word: str) -> float:
        own = known.get(word)
        return known.get(word[:STEM] + "*", other) if own is None else own

    scores = np.fromiter(map(score, words), dtype=np.float64, count=len(words))
    return len(words), maximal_segments(scores)


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other documents of a batch have each token."""
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        columns = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
        for text, toxic in zip(*columns, strict=True):
            words = set(words_of(text))
            counts[toxic].update(words | {stem_of(word) for word in words})
        tokens = [*(counts[0].keys() | counts[1].keys())]
        numbers = [pa.array([counts[k][x] for x in tokens], pa.int64()) for k in (1, 0)]
        yield pa.record_batch([pa.array(tokens, pa.string()), *numbers], names=["token", "x", "y"])


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """``id``, ``text`` and ``toxic`` of the labelled documents, one of each
    text, so that copies do not count as evidence of their own."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    known = labels.select(
        F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic")
    ).filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
    known = broadcast_if_small(stored(known.distinct(), "labels"))
    labelled = rows.select("id", "hash").join(known, "id")
    first = labelled.groupBy("hash", "toxic").agg(F.min("id").alias("id"))
    chosen = broadcast_if_small(stored(first, "training"))
    taught = rows.filter(F.col("text").isNotNull()).join(chosen, ["id", "hash"])
    return taught.select("id", "text", "toxic")


def _log_odds(count: str, n: int, prior: Column, weight: float) -> Column:
    having = F.col(count) + prior
    return F.log(having / (n + weight - having))


def fit_scores(training: DataFrame, held_tokens: int = MODEL_TOKENS) -> tuple[Model, DataFrame]:
    """Token log-odds from all rows of ``text`` and ``toxic``: the model, and the
    table of all significant tokens, ``token`` and ``delta``, for either label.

    Counts are of documents that have a token. Words and their first letters are
    two vocabularies, each with its own totals. A model of more than ``held_tokens``
    tokens has no scores of its own, but those of the table.
    """
    equip(training.sparkSession)
    counts = training.select("text", "toxic").mapInArrow(
        _token_counts, "token string, x long, y long"
    )
    counts = stored(
        counts.groupBy("token")
        .agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
        .withColumn("stem", F.endswith("token", F.lit("*"))),
        "tokens",
    )
    # Two rows at most.
    totals = counts.groupBy("stem").agg(F.sum("x").alias("toxic"), F.sum("y").alias("clean"))
    parts = [training.sparkSession.createDataFrame([], "token string, delta double")]
    other = -1.0
    for total in totals.collect():
        if not total.toxic or not total.clean:
            continue
        prior = F.lit(PRIOR_SHARE) * (F.col("x") + F.col("y"))
        weight = PRIOR_SHARE * (total.toxic + total.clean)
        delta = _log_odds("x", total.toxic, prior, weight) - _log_odds(
            "y", total.clean, prior, weight
        )
        spread = F.sqrt(1 / (F.col("x") + prior) + 1 / (F.col("y") + prior))
        significant = (
            counts.filter(F.col("stem") == total.stem)
            .withColumn("delta", delta)
            .filter(F.abs(F.col("delta") / spread) >= LEAST_Z)
        )
        parts.append(significant.select("token", "delta"))
        if not total.stem:
            held = significant.agg(F.sum("x").alias("x"), F.sum("y").alias("y")).first()
            toxic_left = 1 - (held.x or 0) / total.toxic
            clean_left = 1 - (held.y or 0) / total.clean
            if toxic_left > 0 and clean_left > 0:
                other = math.log(toxic_left / clean_left)
    known = stored(functools.reduce(DataFrame.union, parts), "scores")
    scores = None
    if known.limit(held_tokens + 1).count() <= held_tokens:
        scores = {row.token: row.delta for row in known.collect()}
    # Without drift downwards a segment would never end.
    return Model(scores, min(other, -1e-3)), known


_SEGMENT = T.StructType(
    [
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
_ARROW_SEGMENT = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])


def _find(model):
    """Reads ``id``, ``hash`` and ``text``, and ``known`` tokens of a text if the model has
    none of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, other = model.value.scores, model.value.other
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if scores is None:
                known = [dict(own or ()) for own in batch.column("known").to_pylist()]
            else:
                known = [scores] * len(texts)
            found = [segments_of(t, own, other) for t, own in zip(texts, known, strict=True)]
            lists = [[segment._asdict() for segment in segments] for _, segments in found]
            yield pa.record_batch(
                [
                    *batch.select(["id", "hash"]).columns,
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array(lists, pa.list_(_ARROW_SEGMENT)),
                ],
                names=["id", "hash", "n_words", "segments"],
            )

    return run


def _tokens_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens that each text may take a score from, once each."""
    for batch in batches:
        rows, tokens = [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            words = set(words_of(text))
            own = words | {stem_of(word) for word in words}
            rows += [row] * len(own)
            tokens += own
        taken = batch.select(["id", "row"]).take(pa.array(rows, pa.int64()))
        yield pa.record_batch(
            [*taken.columns, pa.array(tokens, pa.string())], names=["id", "row", "token"]
        )


def _with_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with the scores of their own tokens, by joins: no task holds more
    than those of its texts."""
    keyed = rows.withColumn("row", F.xxhash64("id", "text"))
    added = [T.StructField("row", T.LongType()), T.StructField("token", T.StringType())]
    schema = T.StructType([rows.schema["id"], *added])
    tokens = keyed.select("id", "row", "text").mapInArrow(_tokens_of_texts, schema)
    by_row = (
        tokens.join(known, "token")
        .groupBy(F.col("id").alias("own_id"), F.col("row").alias("own_row"))
        .agg(F.map_from_entries(F.collect_set(F.struct("token", "delta"))).alias("known"))
    )
    same = (F.col("row") == F.col("own_row")) & F.col("id").eqNullSafe(F.col("own_id"))
    return keyed.join(by_row, same, "left").select("id", "hash", "text", "known")


def find_segments(
    docs: DataFrame,
    model: Model,
    known: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id``, a ``hash`` of the text, ``n_words`` and all maximal ``segments`` of
    each row, whole texts.

    ``known`` are the scores of a model that has none of its own."""
    equip(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("hash"),
        F.col(text_column).alias("text"),
    )
    if model.scores is None:
        rows = _with_known(rows, known)
    added = [
        T.StructField("hash", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("segments", T.ArrayType(_SEGMENT)),
    ]
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.select(F.col(id_column).alias("id")).schema["id"], *added])
    return rows.mapInArrow(_find(broadcast), schema)


def _best(segments: str = "segments") -> Column:
    return F.coalesce(F.array_max(F.transform(segments, lambda x: x.score)), F.lit(0.0))


def _surplus(score: Column, model: Model) -> Column:
    """A segment's score in units of the distribution, above what chance gives."""
    length = F.log(F.greatest("n_words", F.lit(1)))
    return F.lit(model.scale) * score - F.lit(model.log_size) - length


def with_evidence(found: DataFrame, model: Model) -> DataFrame:
    """Adds the significant ``passages`` and the ``evidence``, the sum of what
    they score above chance."""
    least = -math.log(MOST_CHANCE_FINDS)
    passages = F.filter("segments", lambda x: _surplus(x.score, model) >= least)
    return found.withColumn("passages", passages).withColumn(
        "evidence",
        F.aggregate("passages", F.lit(0.0), lambda total, x: total + _surplus(x.score, model)),
    )


def fit_extremes(clean: DataFrame, model: Model) -> Model:
    """Scale and size of the extreme-value distribution of the best segment, by
    its moments over clean documents. For log-odds the scale is 1 in theory;
    real texts may have a longer tail, never a shorter one."""
    best = _best()
    row = (
        clean.filter(F.col("n_words") > 0)
        .agg(
            F.avg(best).alias("mean"),
            F.stddev_pop(best).alias("spread"),
            F.avg(F.log("n_words")).alias("n"),
        )
        .first()
    )
    if row["mean"] is None:
        return model
    scale = min(1.0, math.pi / (row["spread"] * math.sqrt(6))) if row["spread"] else 1.0
    return model._replace(scale=scale, log_size=scale * row["mean"] - _EULER - row["n"])


def fit_calibration(evidence: DataFrame, model: Model) -> Model:
    """Slope and offset that turn evidence into the probability of the label, by
    logistic regression on the histogram of ``evidence`` and ``toxic``."""
    steps = F.round(F.least("evidence", F.lit(MOST_EVIDENCE)), 1)
    # At most a thousand steps for each label.
    rows = evidence.groupBy(steps.alias("x"), "toxic").count().collect()
    x = np.array([row["x"] for row in rows], dtype=float)
    y = np.array([row["toxic"] for row in rows], dtype=float)
    n = np.array([row["count"] for row in rows], dtype=float)
    if len(set(y)) < 2:
        return model._replace(slope=1.0, offset=-4.0)
    design = np.column_stack([x, np.ones_like(x)])
    # A weak pull towards a slope of 1 and an offset of -4 keeps both finite.
    centre, pull = np.array([1.0, -4.0]), np.array([0.5, 0.5])
    weights = centre.copy()
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        slope = design.T @ (n * (y - chance)) - pull * (weights - centre)
        curve = (design * (n * chance * (1 - chance))[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        weights = weights + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return model._replace(slope=float(max(weights[0], 1e-6)), offset=float(weights[1]))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    held_tokens: int = MODEL_TOKENS,
) -> DataFrame:
    """``id``, ``n_words``, significant ``passages``, ``evidence``, ``score`` (the
    calibrated probability) and ``predicted`` of each row.

    The model is learned from the labelled documents for which ``learn_from``, a
    condition on the id column, holds. NULL and empty texts have no words and the
    score of no evidence. Repeated rows are scored alike and learned from once.
    Without labels of both kinds no token counts, and all scores are low. Tasks
    hold the scores of up to ``held_tokens`` tokens; of more, those of their texts,
    which come by a join, and the result is the same.
    """
    learned = docs.filter(learn_from)
    training = training_rows(
        learned, labels.filter(learn_from), id_column, text_column, label_column
    )
    model, known = fit_scores(training, held_tokens)
    found = stored(find_segments(docs, model, known, id_column, text_column), "segments")
    # Another text under the same id has no label.
    told = training.select("id", F.xxhash64("text").alias("hash"), "toxic")
    taught = broadcast_if_small(stored(told, "taught"))
    sample = stored(found.join(taught, ["id", "hash"]), "calibration")
    model = fit_extremes(sample.filter("toxic = 0"), model)
    model = fit_calibration(with_evidence(sample, model), model)
    raw = F.lit(model.slope) * F.col("evidence") + F.lit(model.offset)
    return (
        with_evidence(found, model)
        .drop("segments", "hash")
        .withColumn("score", 1 / (1 + F.exp(-raw)))
        .withColumn("predicted", (F.col("score") >= PREDICTED_FROM).cast("int"))
    )


def held_out(id_column: Column, folds: int = 3, part: int = 1) -> Column:
    """Whether a row is kept from learning; a NULL id is not."""
    return F.coalesce(fold(id_column, folds) == part, F.lit(False))
