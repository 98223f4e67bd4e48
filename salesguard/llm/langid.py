"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its words' 2- to 4-byte subwords,
hashed to buckets; a linear softmax over that mean gives the language. Both
layers are trained together by stochastic gradient descent in numpy, in one
task, on a sample of bounded size. Scores are temperature-scaled on rows kept
out of the fit, and texts scored below a threshold found there are marked
``rejected``. Prediction is a scan without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, DIM = 1 << 16, 16
#: The fit reads about so many labelled texts of a language, and at most so many of all: distinct pairs of
#: id and text, those with the smallest hash.
PER_LANG, IN_ALL = 700, 6_000
#: Of a longer text the fit takes so many slices of so many bytes, at equal distances from its begin to its end.
SLICES, SLICE = 40, 1_000
UNKNOWN = "und"
CHUNK = 1 << 20
_SIZES = (2, 3, 4)
_MIX = np.uint32(0x9E3779B1)


def _table() -> np.ndarray:
    """Byte classes: separators and other ASCII that is not a letter become a
    blank, A-Z become a-z."""
    t = np.arange(256, dtype=np.uint8)
    for b in range(128):
        t[b] = ord(chr(b).lower()) if chr(b).isalpha() else 32
    return t


_FOLD = _table()


def subwords(raw: bytes) -> np.ndarray:
    """Buckets of the subwords of a text's UTF-8 bytes; none spans two words."""
    b = _FOLD[np.frombuffer(b" " + raw + b" ", np.uint8)].astype(np.uint32)
    blank = b == 32
    out, h = [], b * np.uint32(0x85EBCA6B)
    for n in range(2, max(_SIZES) + 1):
        if len(b) < n:
            break
        h = (h[:-1] ^ (b[n - 1:] + np.uint32(0x7F4A7C15))) * _MIX
        h ^= h >> np.uint32(15)
        inner = np.zeros(len(h), bool) if n > 2 else blank[:-1] & blank[1:]
        for k in range(1, n - 1):
            inner |= blank[k:k + len(h)]
        out.append((h[~inner] >> np.uint32(16)) & np.uint32(BUCKETS - 1))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def encode(text: str | None) -> bytes | None:
    """UTF-8 bytes; None for a text that is null or has no letter."""
    if text is None or not any(map(str.isalpha, text)):
        return None
    return text.encode("utf-8", "surrogatepass")


class Model:
    """Trained layers: ``names`` sorted, ``embed`` (buckets x dim), ``out`` (dim x languages)."""

    def __init__(self, names: list[str], embed: np.ndarray, out: np.ndarray):
        self.names, self.temperature, self.threshold = names, 1.0, 0.0
        # Layers are linear up to the softmax, so with few languages one table holds their product.
        self.table, self.out = (embed @ out, None) if len(names) <= DIM else (embed, out)

    def dump(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def load(cls, blob: bytes) -> Model:
        out = object.__new__(cls)
        vars(out).update(pickle.loads(blob))
        return out

    def logits(self, raw: bytes) -> np.ndarray:
        total, n = np.zeros(self.table.shape[1]), 0
        for at in range(0, max(1, len(raw)), CHUNK):     # a long text's subwords are summed by pieces
            part = subwords(raw[max(0, at - 3):at + CHUNK])
            counts = np.bincount(part, minlength=BUCKETS) if len(part) > BUCKETS // 4 else None
            total += (self.table[part].sum(axis=0, dtype=np.float64) if counts is None else counts @ self.table)
            n += len(part)
        mean = total / max(1, n)
        return mean if self.out is None else mean @ self.out

    def predict(self, raw: bytes) -> tuple[str, float]:
        p = softmax(self.logits(raw) / self.temperature)
        k = int(np.argmax(p))
        return self.names[k], float(p[k])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[bytes, str]], epochs: int = 6, rate: float = 0.4, seed: int = 11,
          accuracy: float = 0.99) -> Model | None:
    """SGD over the texts and a short slice of each; a fifth calibrates.

    The temperature minimises the held log loss; the threshold is the lowest
    score from which held texts are right with at least ``accuracy``.
    """
    if not rows:
        return None
    names = sorted({y for _, y in rows})
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held, fit = rows[:len(rows) // 5], rows[len(rows) // 5:]
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(names)), np.float32)
    bags = []
    for raw, y in fit:
        a = int(rng.integers(0, max(1, len(raw) - 60)))
        for piece in (raw, raw[a:a + 60]):
            ids, n = np.unique(subwords(piece), return_counts=True)
            if len(ids):
                bags.append((ids, (n / n.sum()).astype(np.float32), names.index(y)))
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            ids, share, y = bags[k]
            lr = rate * (1 - done / steps)
            done += 1
            mean = share @ embed[ids]
            err = softmax(mean @ out)
            err[y] -= 1
            embed[ids] -= lr * len(ids) ** 0.5 * share[:, None] * (out @ err)[None, :]
            out -= lr * np.outer(mean, err)
    model = Model(names, embed, out)
    held = [(model.logits(raw), names.index(y)) for raw, y in held]
    if held:
        loss = lambda t: -np.mean([np.log(max(softmax(z / t)[y], 1e-300)) for z, y in held])
        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
        scored = sorted(((float(p.max()), int(np.argmax(p)) == y) for z, y in held
                         for p in [softmax(z / model.temperature)]), reverse=True)
        right, model.threshold = 0, 1.0
        for n, (s, ok) in enumerate(scored, 1):
            right += ok
            if right >= accuracy * n:
                model.threshold = s
    return model


def spread_slices(raw: bytes) -> bytes:
    """A text's bytes for the fit: all of them, or of a long text slices from all over it."""
    if len(raw) <= SLICES * SLICE:
        return raw
    starts = np.linspace(0, len(raw) - SLICE, SLICES).astype(int)
    return b" ".join(raw[a:a + SLICE] for a in starts.tolist())


def fit(docs: DataFrame, learn_from, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
        per_lang: int = PER_LANG, in_all: int = IN_ALL) -> Model | None:
    """Trains on a bounded sample of the rows where ``learn_from`` (a column) holds and
    the text has a letter.

    The sample is of distinct (id, text) pairs, one row for each, so copies of a
    row count once; texts of any length may be drawn. None if there is no such row."""
    rows = docs.where(learn_from & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}")).select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t"), F.col(lang).alias("_y"), F.col(text).alias("_x"))
    pairs = rows.select("_id", "_t", "_y").distinct()
    # Each language gives about as many as a share of its hashes holds; no language meets in one task.
    counts = pairs.groupBy("_y").agg(F.count("*").alias("_n"))
    place = F.shiftrightunsigned(F.xxhash64("_id", "_t", "_y"), 1)
    rank = place / 2.0 ** 63 * F.col("_n")                 # about the pair's place in its language
    few = pairs.join(counts, "_y").where(rank <= per_lang).orderBy(rank, "_id", "_t", "_y").limit(in_all).select("_id", "_t", "_y")
    same = [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in ("_id", "_t", "_y")]
    few = few.select(*[F.col(c).alias(f"{c}2") for c in few.columns])
    sample = rows.join(F.broadcast(few), same[0] & same[1] & same[2], "left_semi").groupBy("_id", "_t", "_y").agg(F.min("_x").alias("_x"))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = [spread_slices(encode(x) or b"") for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), b.column(1)], ["_x", "_y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(x, y) for b in batches for x, y in zip(*(b.column(n).to_pylist() for n in (0, 1)), strict=True)]
        model = train(sorted((x, y) for x, y in rows if x))
        yield pa.RecordBatch.from_arrays([pa.array([model.dump() if model else b""], pa.binary())], ["model"])

    kind = docs.schema[lang].dataType.simpleString()
    got = sample.select("_x", "_y").mapInArrow(slices, f"_x binary, _y {kind}").repartition(1).mapInArrow(run, "model binary").first()
    return Model.load(bytes(got[0])) if got and got[0] else None


def identify(docs: DataFrame, model: Model | None, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` (a learned language; ``und`` if the text is null or has
    no letter), ``score`` (0 to 1; 0 with ``und``) and ``rejected`` (score below
    the calibrated threshold) to every row (of ``columns``,
    by default all).

    Without a model (nothing to learn from) every row is ``und``. Extra columns
    stay; those with the added names are replaced. Repeated rows are each
    predicted, an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.dump() if model else b"")
    added = ("lang_pred", "score", "rejected", "_text")
    keep = [f for f in docs.schema.fields if f.name not in added and (columns is None or f.name in columns)]
    names = [f.name for f in keep]
    docs = docs.select(*[F.col(f"`{n}`") for n in names], F.col(text).alias("_text"))
    at = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.load(shared.value) if shared.value else None
        for b in batches:
            raws = (None if own is None else encode(t) for t in b.column(at).to_pylist())
            got = [(UNKNOWN, 0.0) if raw is None else own.predict(raw) for raw in raws]
            cut = own.threshold if own else 1.0
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at], pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64()),
                 pa.array([s < cut or x == UNKNOWN for x, s in got], pa.bool_())],
                [*names, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
