"""Language identification by nearest centroids of character n-grams.

A text's vector counts its hashed letter n-grams (one to three letters, with word borders), damped
by logarithm, weighted by inverse document frequency and normalised. Each language has several
centroids, found by spherical k-means over a bounded sample of its labelled texts; a text gets the
language of the centroid with the greatest cosine. It is rejected if its distance (one minus the cosine)
leaves less cosine than the language's floor: ``SLACK`` of the ``QUANTILE`` of the cosines that one half of the sampled
texts has to centroids of the other half. A text of fewer than ``FULL`` different n-grams has a smaller cosine by nature,
so cosines are divided by the root of its share of ``FULL`` first. A language with one text has floor 0.

Document frequencies count all labelled texts. The sample is bounded by ``PER_LANGUAGE`` texts of each
language, taken by a hash of doc_id, so reruns agree.

Cases: null text and text without a letter are ``und`` with score 0 and are rejected. Without any
labelled text everything is ``und``. Rows with a null doc_id are predicted but never learned from. An empty table gives an empty result.
Ties go to the first centroid in the order of languages. Texts of any length are counted whole. Further columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from hangtally.llm.common import batch, prepare

#: Hashed dimensions, centroids of a language, and texts of a language that the fit may use at most (on average).
DIMENSIONS, CENTROIDS, PER_LANGUAGE, ROUNDS = 4096, 4, 1000, 12
#: Share of the floor's quantile that is enough, the quantile, and different n-grams from which a text counts as long.
SLACK, QUANTILE, FULL = 0.5, 0.05, 256
UNKNOWN = "und"
#: Texts whose vectors a task holds at once.
SLICE = 64

_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) and c.max() > 0xFFFF:
        high = c > 0xFFFF
        letters = [x for x in np.unique(c[high]).tolist() if chr(x).isalpha()]
        letter = np.where(high, np.isin(c, np.array(letters, np.uint32)), _LETTER[np.where(high, 0, c)])
    else:
        letter = _LETTER[c]
    if not letter.any():
        return None
    c = np.concatenate([[0], np.where(letter, c, 0), [0]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]   # one border between words
    one, two = c * np.uint32(0x9E3779B1), c * np.uint32(0x85EBCA77)
    pair = one[:-1] ^ np.roll(two, -1)[:-1]
    three = (pair * np.uint32(0xC2B2AE3D))[:-1] ^ one[2:]
    hashed = np.concatenate([one[c != 0], pair * np.uint32(0x27D4EB2F), (three * np.uint32(0x165667B1))[c[1:-1] != 0]])
    return np.bincount(((hashed ^ (hashed >> 15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(20), minlength=DIMENSIONS)


def length_share(rows: np.ndarray) -> np.ndarray:
    """Share of a long text's cosine that texts with these counts can be held to."""
    return np.sqrt(np.minimum(1, (rows > 0).sum(1) / FULL))


@dataclass
class Model:
    weights: np.ndarray       # inverse document frequencies
    languages: list[str]      # of each centroid
    centroids: np.ndarray
    floors: np.ndarray        # least cosine of a long text that is not rejected

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        v = (np.log1p(rows) * self.weights).astype(np.float32)
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        made = [counts(t) if t else None for t in texts]
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        some = [i for i, m in enumerate(made) if m is not None]
        if some and self.languages:
            rows = np.stack([made[i] for i in some])
            near, share = self.vectors(rows) @ self.centroids.T, length_share(rows).tolist()
            best = near.argmax(1)
            for i, b, s, h in zip(some, best.tolist(), near.max(1).tolist(), share):
                s = min(1.0, max(0.0, s))
                out[i] = (self.languages[b], s, s < float(self.floors[b]) * h)
        return out


def clustered(v: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts: centroids and all cosines to them."""
    c = [v[0]]
    far = v @ v[0]
    for _ in range(1, min(k, len(v))):
        c.append(v[far.argmin()])
        far = np.maximum(far, v @ c[-1])
    c = np.stack(c)
    for _ in range(rounds):
        own = (v @ c.T).argmax(1)
        for j in range(len(c)):
            if (own == j).any():
                m = v[own == j].sum(0)
                c[j] = m / max(np.linalg.norm(m), 1e-30)
    near = v @ c.T
    return c, near


def floor_of(v: np.ndarray, share: np.ndarray) -> float:
    """Least cosine of a long text, from cosines of each half of the texts to centroids of the other half."""
    halves = np.arange(len(v)) % 2 == 0
    if halves.all():
        return 0.0
    found = [(v[~h] @ clustered(v[h], CENTROIDS)[0].T).max(1) / share[~h] for h in (halves, ~halves)]
    return SLACK * max(0.0, float(np.quantile(np.concatenate(found), QUANTILE)))


def labelled(docs: DataFrame) -> DataFrame:
    """The rows to learn from: text and language given, and not held out."""
    return docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (held_out() == False)).select("doc_id", "text", "lang")  # noqa: E712


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(rows: DataFrame) -> Model:
    """Learns from rows (doc_id, text, lang)."""
    prepare(rows.sparkSession)
    rows = rows.where("doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang")
    out = "dimension int, docs bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)   # the last counts the texts
        for b in batches:
            for text in b.column(0).to_pylist():
                if (m := counts(text)) is not None:
                    total[:-1] += m > 0
                    total[-1] += 1
        yield batch(schema, np.arange(DIMENSIONS + 1, dtype=np.int32), total)

    found = rows.select("text").mapInArrow(frequencies, out).groupBy("dimension").agg(F.sum("docs")).collect()   # DIMENSIONS + 1 rows
    seen = np.zeros(DIMENSIONS + 1)
    for d, n in found:
        seen[d] = n
    weights = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    # one row per language: the label set, not the corpus
    shares = {r["lang"]: min(1.0, PER_LANGUAGE / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return Model(weights, [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])[F.col("lang")]
    order = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
    sample = rows.withColumn("_order", order).where(F.col("_order") < share * 1_000_000)
    model = Model(weights, [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0))

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "doc_id"])
        made = [m for t in group["text"] if (m := counts(t)) is not None]
        if not made:
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        made = np.stack(made)
        v = model.vectors(made)
        c, _ = clustered(v, CENTROIDS)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(c), "centroid": [x.astype("<f4").tobytes() for x in c], "floor": [floor_of(v, length_share(made))] * len(c)})

    fitted = sorted(sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, floor double").collect())
    if not fitted:
        return model
    return Model(weights, [r["lang"] for r in fitted], np.stack([np.frombuffer(r["centroid"], "<f4") for r in fitted]), np.array([r["floor"] for r in fitted]))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, lang_pred, score, rejected."""
    prepare(docs.sparkSession)
    schema = StructType([docs.schema[c] for c in keep] + _parse_datatype_string("lang_pred string, score double, rejected boolean").fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                yield batch(arrow, *part.columns[:-1], *zip(*model.predict(part.column(len(keep)).to_pylist())))

    return docs.select(*keep, F.col("text").alias("_value")).mapInArrow(work, schema)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are not rejected; columns as they are. Only texts pass through Python, rows stay in the JVM."""
    prepare(docs.sparkSession)

    def known(texts: pa.Array) -> pa.Array:
        return pa.array([not r for at in range(0, len(texts), SLICE) for _, _, r in model.predict(texts[at:at + SLICE].to_pylist())], pa.bool_())

    return docs.where(F.arrow_udf(known, "boolean")(F.col("text")))
