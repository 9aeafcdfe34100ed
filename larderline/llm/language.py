"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads a word's UTF-8 bytes from both ends and labels every byte with
probabilities of the languages. A document's languages are pooled over all its
bytes. State begins anew with each word, so a word has the same labels wherever
it stands: each task labels a word once and counts it as often as it occurs.

The network is trained here, in numpy, by backpropagation through time, on words
of a bounded sample of documents of each language.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import broadcast_if_small, equip, stored

UNKNOWN = "und"

# The training sample: at most so many documents of a language, and at most so
# many words of each, spread evenly over the text.
SAMPLE_DOCS = 600
SAMPLE_WORDS = 120

HIDDEN = 16
STEPS = 1500
BATCH = 256
RATE = 0.01
SEED = 7
# Bytes of a word the network reads at once; longer words are cut.
MOST_BYTES = 32
# Words whose labels a task remembers, and words labelled in one go.
REMEMBERED = 400_000
AT_ONCE = 4096

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The runs of letters, lower-cased."""
    return _LETTERS.findall((text or "").lower())


def _byte_rows(words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The words' bytes in pieces, by the length of the piece: which word each
    piece is of, and a row of bytes for it."""
    owners, pieces = defaultdict(list), defaultdict(list)
    for number, word in enumerate(words):
        data = word.encode("utf-8", "surrogatepass")
        for start in range(0, len(data), MOST_BYTES):
            piece = data[start : start + MOST_BYTES]
            owners[len(piece)].append(number)
            pieces[len(piece)].append(piece)
    return {
        length: (
            np.array(owners[length]),
            np.frombuffer(b"".join(pieces[length]), dtype=np.uint8).reshape(-1, length),
        )
        for length in pieces
    }


class _Trace(NamedTuple):
    """What a direction has worked out, step by step, for the way back."""

    states: list[np.ndarray]
    gates: list[np.ndarray]
    candidates: list[np.ndarray]
    inner: list[np.ndarray]


class Network:
    """Two gated recurrent units, one for each direction, and a softmax."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        scale = 1 / np.sqrt(hidden)

        def drawn(*shape: int) -> np.ndarray:
            return draw.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            "out": drawn(2 * hidden, len(languages)),
            "bias": np.zeros(len(languages), np.float32),
        }
        for side in ("ahead", "back"):
            # What each byte value adds to the gates and the candidate, and how
            # the state feeds them.
            self.weights[f"{side}_byte"] = drawn(256, 3 * hidden)
            self.weights[f"{side}_state"] = drawn(hidden, 3 * hidden)

    def _run(self, side: str, rows: np.ndarray) -> _Trace:
        h = self.hidden
        state = np.zeros((len(rows), h), np.float32)
        trace = _Trace([state], [], [], [])
        for at in range(rows.shape[1]):
            fed = self.weights[f"{side}_byte"][rows[:, at]]
            own = state @ self.weights[f"{side}_state"]
            gates = 1 / (1 + np.exp(-(fed[:, : 2 * h] + own[:, : 2 * h])))
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(fed[:, 2 * h :] + reset * own[:, 2 * h :])
            state = candidate + update * (state - candidate)
            trace.states.append(state)
            trace.gates.append(gates)
            trace.candidates.append(candidate)
            trace.inner.append(own[:, 2 * h :])
        return trace

    def _joined(self, ahead: _Trace, back: _Trace) -> np.ndarray:
        """States of both directions at each byte."""
        return np.concatenate(
            [np.stack(ahead.states[1:], axis=1), np.stack(back.states[:0:-1], axis=1)], axis=2
        )

    def _log_labels(self, joined: np.ndarray) -> np.ndarray:
        raw = joined @ self.weights["out"] + self.weights["bias"]
        raw -= raw.max(axis=2, keepdims=True)
        return raw - np.log(np.exp(raw).sum(axis=2, keepdims=True))

    def log_labels(self, rows: np.ndarray) -> np.ndarray:
        """Log probabilities of the languages at each byte of equally long rows."""
        return self._log_labels(
            self._joined(self._run("ahead", rows), self._run("back", rows[:, ::-1]))
        )

    def _back_through_time(self, side: str, rows: np.ndarray, trace: _Trace, wanted: np.ndarray):
        """Slopes of a direction's weights, from the slopes of its states."""
        h = self.hidden
        by_state = self.weights[f"{side}_state"]
        of_bytes = np.zeros((256, 3 * h), np.float32)
        of_state = np.zeros_like(by_state)
        later = np.zeros((len(rows), h), np.float32)
        for at in range(rows.shape[1] - 1, -1, -1):
            before, candidate = trace.states[at], trace.candidates[at]
            update, reset = trace.gates[at][:, :h], trace.gates[at][:, h:]
            slope = later + wanted[:, at]
            of_candidate = slope * (1 - update) * (1 - candidate * candidate)
            of_update = slope * (before - candidate) * update * (1 - update)
            of_reset = of_candidate * trace.inner[at] * reset * (1 - reset)
            fed = np.concatenate([of_update, of_reset, of_candidate], axis=1)
            own = np.concatenate([of_update, of_reset, of_candidate * reset], axis=1)
            np.add.at(of_bytes, rows[:, at], fed)
            of_state += before.T @ own
            later = slope * update + own @ by_state.T
        return of_bytes, of_state

    def slopes(self, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the mean loss over all bytes of the rows."""
        ahead, back = self._run("ahead", rows), self._run("back", rows[:, ::-1])
        joined = self._joined(ahead, back)
        error = np.exp(self._log_labels(joined))
        error[np.arange(len(rows)), :, labels] -= 1
        error /= rows.size
        flat = joined.reshape(-1, joined.shape[2])
        found = {"out": flat.T @ error.reshape(len(flat), -1), "bias": error.sum(axis=(0, 1))}
        wanted = error @ self.weights["out"].T
        sides = (
            ("ahead", rows, ahead, wanted[:, :, : self.hidden]),
            ("back", rows[:, ::-1], back, wanted[:, ::-1, self.hidden :]),
        )
        for side, own, trace, slope in sides:
            found[f"{side}_byte"], found[f"{side}_state"] = self._back_through_time(
                side, own, trace, slope
            )
        return found


def trained(samples: dict[str, list[str]], steps: int = STEPS, seed: int = SEED) -> Network:
    """A network for the languages of the samples, each a list of words.

    A batch has words of one length, drawn evenly from the languages that have
    some, so no language gains by being frequent. Weights move by Adam.
    """
    languages = sorted(samples)
    network = Network(languages, seed=seed)
    draw = np.random.default_rng(seed)
    by_length: dict[int, list] = defaultdict(list)
    weight: Counter = Counter()
    for label, language in enumerate(languages):
        for length, (_, rows) in sorted(_byte_rows(samples[language]).items()):
            by_length[length].append((label, rows))
            weight[length] += rows.size
    lengths = np.array(sorted(weight))
    chance = np.array([weight[length] for length in lengths], dtype=float)
    chance /= chance.sum()
    first = {name: np.zeros_like(value) for name, value in network.weights.items()}
    second = {name: np.zeros_like(value) for name, value in network.weights.items()}
    for step in range(1, steps + 1):
        groups = by_length[int(draw.choice(lengths, p=chance))]
        each = -(-BATCH // len(groups))
        rows = np.concatenate([own[draw.integers(len(own), size=each)] for _, own in groups])
        labels = np.repeat([label for label, _ in groups], each)
        rate = RATE * (1 - step / (steps + 1))
        for name, slope in network.slopes(rows, labels).items():
            first[name] += 0.1 * (slope - first[name])
            second[name] += 0.001 * (slope * slope - second[name])
            move = first[name] / (1 - 0.9**step)
            spread = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
            network.weights[name] -= rate * move / spread
    return network


class _Labels:
    """Sums of log labels over a word's bytes, remembered by word."""

    def __init__(self, network: Network):
        self.network = network
        self.numbers: dict[str, int] = {}
        self.sums = np.zeros((0, len(network.languages)), np.float32)

    def learn(self, words: set[str]) -> None:
        """Label the words not known yet. If there are too many, forget first."""
        if len(self.numbers) > REMEMBERED:
            self.numbers, self.sums = {}, self.sums[:0]
        fresh = [word for word in words if word not in self.numbers]
        sums = np.zeros((len(fresh), self.sums.shape[1]), np.float32)
        for owners, rows in _byte_rows(fresh).values():
            for start in range(0, len(rows), AT_ONCE):
                part = slice(start, start + AT_ONCE)
                np.add.at(sums, owners[part], self.network.log_labels(rows[part]).sum(axis=1))
        known = len(self.sums)
        self.numbers.update((word, known + at) for at, word in enumerate(fresh))
        self.sums = np.concatenate([self.sums, sums])

    def pooled(self, counts: Counter) -> np.ndarray:
        """Probabilities of the languages: the mean over all bytes of their log
        probabilities, made to sum to one."""
        numbers = [self.numbers[word] for word in counts]
        times = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        n_bytes = sum(len(word.encode("utf-8", "surrogatepass")) * n for word, n in counts.items())
        mean = times @ self.sums[numbers] / n_bytes
        odds = np.exp(mean - mean.max())
        return odds / odds.sum()


def _predict(network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = _Labels(network.value) if network.value.languages else None
        for batch in batches:
            names, scores = [], []
            # A few texts at a time, so that long ones do not pile up.
            for start in range(0, len(batch), 256):
                texts = batch.column("text").slice(start, 256).to_pylist()
                counted = [Counter(words_of(text)) for text in texts]
                if labels:
                    labels.learn(set().union(*counted))
                for counts in counted:
                    # A run may be of characters such as superscripts only.
                    has_letter = any(c.isalpha() for word in counts for c in word)
                    if has_letter and labels:
                        shares = labels.pooled(counts)
                        names.append(network.value.languages[int(shares.argmax())])
                        scores.append(float(shares.max()))
                    else:
                        names.append(UNKNOWN)
                        scores.append(0.0)
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(
                [batch.column("id"), *columns], names=["id", "lang_pred", "score"]
            )

    return run


def _some_words():
    def of(text: str | None) -> list[str]:
        words = words_of(text)
        taken = min(len(words), SAMPLE_WORDS)
        return [words[at * len(words) // taken] for at in range(taken)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [of(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch(
                [batch.column("lang"), pa.array(words, pa.list_(pa.string()))],
                names=["lang", "words"],
            )

    return run


def fit(
    docs: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    steps: int = STEPS,
) -> Network:
    """Train on ``sample_docs`` different texts of each language, or all if there
    are fewer, chosen by a hash of the text, and at most SAMPLE_WORDS words of
    each. Copies count once, so none of them crowd out others, and each language
    has its own share. Rows without language or letters teach nothing; without
    any, no language is known.

    What comes to the driver is bounded by these two numbers for each language.
    """
    equip(docs.sparkSession)
    rows = docs.select(
        F.col(language_column).alias("lang"), F.col(text_column).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    different = stored(hashed.select("lang", "hash").distinct(), "texts")
    # A first cut leaves about twice the wanted number, so that what is ranked
    # below is small however many texts a language has.
    counts = different.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = broadcast_if_small(stored(counts, "languages"))
    every = F.greatest(F.lit(1), F.floor(F.col("n") / (2 * sample_docs)))
    some = different.join(counts, "lang").filter(F.pmod(F.xxhash64("hash"), every) == 0)
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("hash"), "hash")
    ranked = some.withColumn("rank", F.row_number().over(by_hash))
    chosen = ranked.filter(F.col("rank") <= sample_docs).select("lang", "hash")
    picked = hashed.join(F.broadcast(stored(chosen, "chosen")), ["lang", "hash"])
    once = picked.groupBy("lang", "hash").agg(F.first("text").alias("text"))
    sampled = once.mapInArrow(_some_words(), "lang string, words array<string>")
    samples = defaultdict(list)
    for row in sampled.toArrow().to_pylist():
        samples[row["lang"]].extend(row["words"])
    # Sorted, so that training does not depend on the order rows come in.
    samples = {lang: sorted(words) for lang, words in samples.items() if words}
    return trained(samples, steps) if samples else Network([])


def predict(
    docs: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id``, ``lang_pred`` and its ``score`` for each row, whole texts.

    NULL and texts without a letter are ``und`` with score 0, and so is every
    text if no language was learned. Repeated rows are labelled alike; nothing
    is shuffled.
    """
    equip(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([rows.schema["id"], *added])
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(network)), schema)


def fold(id_column: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo the folds; NULL for a NULL id."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds
