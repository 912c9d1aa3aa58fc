"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are words (A-Z lower-cased) and one end per text, the empty word. The vocabulary is open and grows with the corpus,
so the model speaks of *units*: the ``OWN`` most frequent words are units of their own, every other word belongs to one of
``CLASSES`` units by its last three bytes. A token's probability is P(unit | two units before) * P(word | unit):

* the first factor is log-bilinear: the context's vector is the sum of its units' vectors, each scaled by the place it
  stands in; its product with a unit's output vector plus the unit's bias is the logit, normalised over all units. Normalisers
  are found by batched matrix products, once for every different context a task meets;
* the second is (c + 0.1) / (N_u + 0.1 * (V_u + 1)) from the counts of all training words of the unit, 1 for an own unit.

The probabilities of all training words and, per class unit, one share for all others sum to 1.

Training (numpy, AdaGrad, ``NOISE`` noise units shared by a minibatch, drawn from the units' frequencies) reads **every** training
token once: each task trains on its own documents and the parameters are averaged, weighted by tokens. So that the
average makes sense all tasks start from one model, trained on a sample of about ``WARM`` documents (by a hash of doc_id).
Counts cover all training documents. What tasks get is bounded: the parameters and the ``HEAD`` most
frequent words of at most ``LONGEST`` bytes. Counts of all other words are joined, never collected.

Cases: a null text is empty and scores as its end alone. A null doc_id is scored, neither held out nor learned from. Equal
rows and rows of one doc_id are scored each and learned from each. Without training documents every count is 0, and the model is
the one untrained. An empty table gives an empty result. Long texts are read in pieces, cut at spaces. Ties of
frequency go to the smaller word. Further columns of any name are not read. Sums of doubles may differ in the last digits
between runs.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, pieces, prepare, stored

OWN, CLASSES, WIDTH, PLACES = 256, 256, 16, 2
NOISE, MINIBATCH, RATE, WARM = 32, 2048, 0.2, 2000
#: Greatest number of words, and of bytes of a word, that every task knows the counts of.
HEAD, LONGEST = 65_536, 64
#: Words a task counts before it hands them on, and tokens it scores at once.
HELD_WORDS, SLAB = 300_000, 100_000
END = b""
COUNTS, STATE = "word string, n bigint", "place int, value double"
SCORED = ("row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
          "rare array<struct<word: string, times: bigint>>")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """Lists of a text's tokens, the end in the last."""
    held = None
    for piece in pieces((text or b"").lower()):
        if held is not None:
            yield held
        held = piece.split()
    yield [*held, END]


# ---- counts --------------------------------------------------------------------

def counted(docs: DataFrame) -> DataFrame:
    """Rows (word, n) of all tokens; n over the whole table."""
    prepare(docs.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(COUNTS))

    def flushed(n: Counter) -> Iterator[pa.RecordBatch]:
        words, times = list(n), list(n.values())
        for at in range(0, len(words), 50_000):
            yield batch(schema, pa.array(words[at:at + 50_000], pa.binary()).cast(pa.string()), times[at:at + 50_000])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = Counter()
        for b in batches:
            for text in b.column(0):
                for words in words_of(text.as_py()):
                    n.update(words)
                    if len(n) > HELD_WORDS:
                        yield from flushed(n)
                        n = Counter()
        yield from flushed(n)

    return docs.select(F.col("text").cast("binary")).mapInArrow(work, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Frequent words with their counts, and what is known of each unit."""
    words: list[bytes]            # frequent words; END is one of them
    counts: np.ndarray
    units: np.ndarray
    tokens: int                   # N
    distinct: int                 # V
    unit_tokens: np.ndarray       # N_u
    unit_words: np.ndarray        # V_u
    own: int

    @property
    def size(self) -> int:
        return self.own + CLASSES

    def below(self) -> np.ndarray:
        """What a class unit's (c + 0.1) is divided by."""
        return self.unit_tokens + 0.1 * (self.unit_words + 1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a stored table of counts. At most ``HEAD`` words come to the driver."""
    step = F.floor(F.log2("n") * 8).cast("int")
    short = counts.where(f"octet_length(word) between 1 and {LONGEST}").withColumn("step", step)
    least, room = None, HEAD
    for r in short.groupBy("step").agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():   # eight rows for each doubling of n
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    head = [] if least is None else sorted(((-r["n"], r["word"].encode()) for r in short.where(F.col("step") >= least).select("word", "n").collect()))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0)).alias("ends")).first()
    words, n = [END, *(w for _, w in head)], np.array([total["ends"], *(-m for m, _ in head)], np.int64)
    own = min(OWN, len(words))
    ending = F.substring(F.col("word").cast("binary"), -3, 3)
    classes = counts.where("word <> ''").groupBy((F.crc32(ending) % CLASSES).cast("int").alias("unit")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    tokens, kinds = np.zeros(own + CLASSES), np.zeros(own + CLASSES)
    for r in classes.collect():   # one row a class
        tokens[own + r["unit"]], kinds[own + r["unit"]] = r["n"], r["v"]
    units = np.array([k if k < own else own + class_of(w) for k, w in enumerate(words)], np.int32)
    tokens[:own], kinds[:own] = n[:own], 1
    for k, w in enumerate(words[1:own], 1):
        tokens[own + class_of(w)] -= n[k]
        kinds[own + class_of(w)] -= 1
    return Vocabulary(words, n, units, total["n"], total["v"], tokens, kinds, own)


class Coder:
    """Turns tokens into places among the frequent words, and those into units."""

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.places = v, {w: k for k, w in enumerate(v.words)}
        self.classes: dict[bytes, int] = {}

    def places_of(self, words: list[bytes]) -> np.ndarray:
        get = self.places.get
        return np.array([get(w, -1) for w in words], np.int32)

    def units_of(self, words: list[bytes], places: np.ndarray) -> np.ndarray:
        units = self.v.units[places]
        for k in np.flatnonzero(places < 0).tolist():
            ending = words[k][-3:]
            if (c := self.classes.get(ending)) is None:
                if len(self.classes) > 100_000:
                    self.classes.clear()
                c = self.classes[ending] = self.v.own + class_of(ending)
            units[k] = c
        return units


def contexts(units: np.ndarray, before: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The units one and two places before, with those that precede the piece."""
    whole = np.concatenate([np.array(before, units.dtype), units])
    return whole[1:-1], whole[:-2]


# ---- the model -------------------------------------------------------------------

class Model:
    """Parameters in one vector: input vectors (one more for the begin), output vectors, biases, scales of the places; then AdaGrad's sums."""

    def __init__(self, units: int, state: np.ndarray) -> None:
        self.units, self.state = units, np.array(state, np.float32)
        shapes = [(units + 1, WIDTH), (units, WIDTH), (units,), (PLACES, WIDTH), (units + 1, 1), (units, 1), (units,), (PLACES, 1)]
        views, at = [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            views.append(self.state[at:at + n].reshape(shape))
            at += n
        self.inputs, self.outputs, self.bias, self.scale, self.sum_in, self.sum_out, self.sum_bias, self.sum_scale = views

    @classmethod
    def fresh(cls, v: Vocabulary) -> Model:
        k = v.size
        m = cls(k, np.full((2 * k + 1) * WIDTH + k + PLACES * WIDTH + 3 * k + 1 + PLACES, 1e-8))
        r = np.random.default_rng(1)
        # without output vectors it begins as the units' frequencies
        m.inputs[:], m.outputs[:] = r.normal(0, 0.5, m.inputs.shape), 0
        m.bias[:], m.scale[:] = np.log(noise_of(v)), PLACES ** -0.5
        return m

    def train(self, target: np.ndarray, context: tuple[np.ndarray, ...], noise: np.ndarray, drawn: np.ndarray) -> None:
        """One minibatch: tell each target from the drawn noise units, given its context."""
        vectors = [np.take(self.inputs, c, axis=0) for c in context]
        q = sum(x * s for x, s in zip(vectors, self.scale))
        log_noise = np.log(len(drawn) * noise)
        out, out_noise = np.take(self.outputs, target, axis=0), self.outputs[drawn]
        true = np.einsum("ij,ij->i", q, out) + self.bias[target] - log_noise[target]
        false = q @ out_noise.T + (self.bias[drawn] - log_noise[drawn])
        e_true = 1 / (1 + np.exp(np.minimum(true, 30)))
        e_false = 1 / (1 + np.exp(np.minimum(-false, 30)))
        n = np.float32(len(target))
        dq = e_true[:, None] * out - e_false @ out_noise
        change = np.zeros((self.units, WIDTH + 1), np.float32)
        add_rows(change, target, np.column_stack([e_true[:, None] * q, e_true]))
        np.subtract.at(change, drawn, np.column_stack([e_false.T @ q, e_false.sum(0)]))
        change_in = np.zeros_like(self.inputs)
        add_rows(change_in, np.concatenate(context), np.concatenate([dq * s for s in self.scale]))
        change_scale = np.stack([(dq * x).sum(0) for x in vectors])
        for change, value, total, rate in ((change[:, :WIDTH], self.outputs, self.sum_out, 1), (change[:, WIDTH], self.bias, self.sum_bias, 0.3),
                                           (change_in, self.inputs, self.sum_in, 1), (change_scale, self.scale, self.sum_scale, 0.3)):
            change = change / n
            total += (change ** 2).sum(1, keepdims=True) if change.ndim > 1 else change ** 2
            value += RATE * rate * change / np.sqrt(total)

    def normalisers(self, context: tuple[np.ndarray, ...]) -> np.ndarray:
        """Natural logarithm of the sum over all units, per context."""
        out = np.empty(len(context[0]), np.float32)
        for at in range(0, len(out), MINIBATCH):
            q = sum(self.inputs[c[at:at + MINIBATCH]] * s for c, s in zip(context, self.scale))
            logits = q @ self.outputs.T + self.bias
            top = logits.max(1, keepdims=True)
            out[at:at + MINIBATCH] = np.log(np.exp(logits - top).sum(1)) + top[:, 0]
        return out


def add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """to[at] += rows, where places repeat."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    places = at[order]
    begins = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    to[places[begins]] += np.add.reduceat(rows[order], begins, axis=0)


def noise_of(v: Vocabulary) -> np.ndarray:
    n = v.unit_tokens + 0.1
    return (n / n.sum()).astype(np.float32)


def trained(docs: DataFrame, v: Vocabulary, start: np.ndarray) -> np.ndarray:
    """Every task trains from ``start`` on its own documents; the states averaged by tokens."""
    schema = to_arrow_schema(_parse_datatype_string(STATE))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, coder, noise, random = Model(v.size, start), Coder(v), noise_of(v), np.random.default_rng(2)
        cumulated = np.cumsum(noise, dtype=np.float64)
        held, waiting, seen = [], 0, 0

        def learn(least: int) -> None:
            nonlocal held, waiting
            target, one, two = map(np.concatenate, zip(*held))
            for at in range(0, len(target), MINIBATCH):
                part = slice(at, at + MINIBATCH)
                if len(target[part]) < least:
                    break
                drawn = np.minimum(np.searchsorted(cumulated, random.random(NOISE) * cumulated[-1]), v.size - 1)
                model.train(target[part], (one[part], two[part]), noise, drawn)
            else:
                at = len(target)
            held = [(target[at:], one[at:], two[at:])]
            waiting = len(target) - at

        for b in batches:
            for text in b.column(0):
                before = (v.size, v.size)
                for words in words_of(text.as_py()):
                    units = coder.units_of(words, coder.places_of(words))
                    held.append((units, *contexts(units, before)))
                    before = (before + tuple(units[-2:].tolist()))[-2:]
                    waiting, seen = waiting + len(units), seen + len(units)
                    if waiting >= 16 * MINIBATCH:
                        learn(MINIBATCH)
        if seen:
            learn(1)
            yield batch(schema, np.arange(-1, len(start), dtype=np.int32), np.concatenate([[seen], model.state.astype(np.float64) * seen]))

    found = docs.select(F.col("text").cast("binary")).mapInArrow(work, STATE).groupBy("place").agg(F.sum("value")).collect()   # one row a parameter
    if not found:
        return start
    state = np.zeros(len(start) + 1)
    for place, value in found:
        state[place + 1] = value
    return state[1:] / state[0]


def fit(docs: DataFrame, v: Vocabulary) -> np.ndarray:
    """The state of a model trained on all of docs (doc_id, text)."""
    start = Model.fresh(v).state
    texts = max(1, int(v.counts[0]))
    order = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    warm = docs.withColumn("_order", order).where(F.col("_order") < 1_000_000 * WARM / texts).repartition(1).sortWithinPartitions("_order", "doc_id", "text")
    return trained(docs, v, trained(warm, v, start))


# ---- scoring ---------------------------------------------------------------------

class Scorer:
    """Probabilities of tokens; normalisers of contexts are found once and kept."""

    def __init__(self, v: Vocabulary, state: np.ndarray) -> None:
        self.v, self.model, self.coder = v, Model(v.size, state), Coder(v)
        self.known = np.full((v.size + 1) ** 2, np.nan, np.float32)
        self.scaled = [self.model.inputs * s for s in self.model.scale]
        self.base = np.log10((v.counts + 0.1) / (v.tokens + 0.1 * (v.distinct + 1)))
        self.within = np.where(np.arange(len(v.words)) < v.own, 0.0, np.log10(v.counts + 0.1) - np.log10(v.below())[v.units])

    def of_units(self, units: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """log10 P(unit | context) of each token."""
        code = one.astype(np.int64) * (self.v.size + 1) + two
        new = np.unique(code[np.isnan(self.known[code])])
        self.known[new] = self.model.normalisers((new // (self.v.size + 1), new % (self.v.size + 1)))
        q = np.take(self.scaled[0], one, axis=0) + np.take(self.scaled[1], two, axis=0)
        logit = np.einsum("ij,ij->i", q, np.take(self.model.outputs, units, axis=0)) + self.model.bias[units]
        return (logit - self.known[code]).astype(np.float64) / np.log(10)

    def texts(self, texts: Iterator[bytes | None]) -> Iterator[tuple[int, int, float, float, list[dict]]]:
        """Per text: tokens, known tokens, base and score but for log10(c + 0.1) of the rare words, and these with their times.

        The pieces of many texts are scored together, ``SLAB`` tokens or more at once.
        """
        held, size, done = [], 0, []

        def close() -> Iterator[tuple]:
            whole = [np.concatenate(x) for x in zip(*(h[1:4] for h in held))]
            places = np.concatenate([h[4] for h in held])
            score = self.of_units(*whole) + np.where(places < 0, -np.log10(self.v.below())[whole[0]], self.within[places])
            base = np.where(places < 0, -np.log10(self.v.tokens + 0.1 * (self.v.distinct + 1)), self.base[places])
            begins = np.cumsum([0] + [len(h[4]) for h in held[:-1]])
            columns = [np.add.reduceat(x, begins).tolist() for x in (np.ones(len(places), np.int64), ((places >= 0) & (self.v.counts[places] > 0)).astype(np.int64), base, score)]
            for (last, *_, rare), n, known, b, s in zip(held, *columns):
                done.append((n, known, b, s, rare))
                if last:
                    total = Counter()
                    for x in done:
                        total.update(x[4])
                    yield (*(sum(x[k] for x in done) for k in range(4)), [{"word": w.decode(), "times": t} for w, t in total.items()])
                    done.clear()
            held.clear()

        for text in texts:
            before, lists = (self.v.size, self.v.size), words_of(text)
            words = next(lists)
            while words is not None:
                after = next(lists, None)
                places = self.coder.places_of(words)
                units = self.coder.units_of(words, places)
                held.append((after is None, units, *contexts(units, before), places, Counter(words[k] for k in np.flatnonzero(places < 0).tolist())))
                before = (before + tuple(units[-2:].tolist()))[-2:]
                size += len(words)
                if size >= SLAB:
                    yield from close()
                    size = 0
                words = after
        if held:
            yield from close()


def scored(docs: DataFrame, counts: DataFrame, v: Vocabulary, state: np.ndarray) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    prepare(docs.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(SCORED))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, scorer, made = deque(), Scorer(v, state), []

        def texts() -> Iterator[bytes | None]:
            for b in batches:
                keys.extend(zip(*(c.to_pylist() for c in b.columns[:3])))
                yield from (t.as_py() for t in b.column(3))

        for out in scorer.texts(texts()):
            made.append((*keys.popleft(), *out))
            if len(made) == 500:
                yield batch(schema, *zip(*made))
                made.clear()
        if made:
            yield batch(schema, *zip(*made))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                       F.col("text").cast("binary"))
    parts = stored(rows.mapInArrow(work, SCORED), "scored-parts")
    rare = parts.select("row", F.inline("rare")).join(counts.where("word <> ''"), "word", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10(n + 0.1)).alias("more"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("seen"))
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def report(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and scores all."""
    training = docs.where(~held_out()).select("doc_id", "text")
    counts = stored(counted(training), "word-counts")
    v = vocabulary(counts)
    return scored(docs, counts, v, fit(training, v))
