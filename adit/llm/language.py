"""Language identification with string kernels.

The kernel of two texts is the blended spectrum kernel on presence: for n = 1, 2, 3 the number of
byte n-grams that both have, over the geometric mean of how many each has, averaged over n. A few
hundred labelled texts are landmarks; Nystroem's map turns the kernel values with them into
features, and ridge regression learns each language against the rest. Scoring multiplies a batch's
n-gram matrix with the landmarks' and the result with the weights.

Texts are lower-cased, and ASCII characters other than letters count as spaces. Fitting reads a
bounded sample by hash of the id: about ``PER_LANGUAGE`` texts of each language, however many
languages there are, and at most ``LANDMARKS`` landmarks in all, spread evenly over the languages.
Tasks add up the normal equations of the regression; only these sums reach the driver.

Defined results: ``und`` with score 0 for a null text or one without letters, and for every text
if nothing is labelled; texts are taken whole; repeated rows give equal rows; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, fold, map_rows, table, text_of

NGRAMS = (1, 2, 3)
PER_LANGUAGE = 1500
LANDMARKS = 192
RIDGE = 1e-3
FOLDS, HELD = 4, 2
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_CHUNK = 4_000_000
BROADCAST_LANGUAGES = 100_000


def ngrams(text: str) -> list[np.ndarray]:
    """The distinct codes of the text's byte n-grams, for each n."""
    data = np.frombuffer(text.lower().encode().translate(_TO_SPACE), np.uint8)
    found: list[list[np.ndarray]] = [[] for _ in NGRAMS]
    for start in range(0, max(1, len(data)), _CHUNK):
        part = data[start : start + _CHUNK + max(NGRAMS) - 1].astype(np.uint32)
        codes = part
        for k, n in enumerate(NGRAMS):
            if k:
                codes = codes[:-1] * np.uint32(256) + part[n - 1 :] if len(part) >= n else part[:0]
            found[k].append(np.unique(codes))
    return [x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for x in found]


@dataclass
class Landmarks:
    """Landmark texts as one presence matrix for each n, over the n-grams that any of them has."""

    codes: list[np.ndarray]
    present: list[np.ndarray]

    @staticmethod
    def of(texts: list[str]) -> Landmarks:
        grams = [ngrams(t) for t in texts]
        codes = [np.unique(np.concatenate([g[k] for g in grams])) for k in range(len(NGRAMS))]
        present = []
        for k, known in enumerate(codes):
            p = np.zeros((len(known), len(texts)), np.float32)
            for j, g in enumerate(grams):
                p[np.searchsorted(known, g[k]), j] = 1 / np.sqrt(max(1, len(g[k])))
            present.append(p)
        return Landmarks(codes, present)

    def kernel(self, texts: list[str], block: int = 128) -> np.ndarray:
        """The kernel of each text with each landmark."""
        out = np.zeros((len(texts), self.present[0].shape[1]), np.float32)
        for start in range(0, len(texts), block):
            grams = [ngrams(t) for t in texts[start : start + block]]
            for k, known in enumerate(self.codes):
                if not len(known):
                    continue
                x = np.zeros((len(grams), len(known)), np.float32)
                for i, g in enumerate(grams):
                    at = np.searchsorted(known, g[k])
                    at[at == len(known)] = 0
                    x[i, at[known[at] == g[k]]] = 1 / np.sqrt(max(1, len(g[k])))
                out[start : start + block] += x @ self.present[k]
        return out / len(NGRAMS)


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [t if t and _LETTER.search(t) else "" for t in texts]
        values = self.landmarks.kernel(known) @ self.weights[:-1] + self.weights[-1]
        best = values.argmax(1)
        score = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
        return (
            [self.languages[b] if t else UNKNOWN for b, t in zip(best, known, strict=True)],
            [float(s) if t else 0.0 for s, t in zip(score, known, strict=True)],
        )


def _draw() -> Column:
    """Between 0 and 1, by id and text: rows without an id, or of one id, are drawn apart."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)


def chosen_landmarks(rows: DataFrame, languages: int, landmarks: int) -> list[str]:
    """At most ``landmarks`` texts: the first by hash of each language, then the second of each, and so on."""
    each = -(-landmarks // languages)
    few = rows.where(_draw() < 2 * each / F.col("n"))  # about twice as many as are wanted, in each language
    rank = F.row_number().over(W.partitionBy("lang").orderBy(_draw(), "doc_id", "text"))
    first = few.withColumn("rank", rank).where(F.col("rank") <= each)
    return [r["text"] for r in first.orderBy("rank", F.xxhash64("lang"), "lang").select("text").limit(landmarks).collect()]


def normal_equations(sample: DataFrame, per_language: int, marks: Landmarks, m: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Sums over the sample, languages weighing alike: features times features (and a constant one),
    the names of the languages, and the features of each.

    Each task adds up its own rows; sums of equal place meet by a shuffle.
    """
    shared = sample.sparkSession.sparkContext.broadcast((marks, m))
    schema = pa.schema([("lang", pa.string()), ("i", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        marks, m = shared.value
        d = m.shape[1] + 1
        gram, of = np.zeros((d, d)), {}
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                lang, n = part.column(0).to_pylist(), np.array(part.column(1), float)
                phi = np.column_stack([marks.kernel(part.column(2).to_pylist()) @ m, np.ones(len(lang))])
                weighed = phi / np.minimum(n, per_language)[:, None]
                gram += phi.T @ weighed
                for name, row in zip(lang, weighed, strict=True):
                    of[name] = of.get(name, 0) + row
        sums = [(None, i, gram[i]) for i in range(d)] * bool(of) + [(name, -1, of[name]) for name in sorted(of)]
        for start in range(0, len(sums), 1000):
            names, at, values = zip(*sums[start : start + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int32()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))], schema=schema)

    parts = sample.select("lang", "n", "text").mapInArrow(run, "lang string, i int, sums array<double>")
    each = parts.select("lang", "i", F.posexplode("sums").alias("j", "x")).groupBy("lang", "i", "j").agg(F.sum("x").alias("x")).toArrow()
    d = m.shape[1] + 1
    names = sorted({x for x in each["lang"].to_pylist() if x is not None})
    number = {name: k for k, name in enumerate(names)}
    gram, of = np.zeros((d, d)), np.zeros((len(names), d))
    for name, i, j, x in zip(*[each[c].to_pylist() for c in ("lang", "i", "j", "x")], strict=True):
        if name is None:
            gram[i, j] = x
        else:
            of[number[name], j] = x
    return gram, names, of


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS
) -> Model | None:
    """Fit on labelled documents with letters; their kernel values are computed on the cluster."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = checkpointed(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    languages = counts.count()
    if not languages:
        return None
    of = counts.withColumnRenamed("lang", "of")
    rows = rows.join(F.broadcast(of) if languages <= BROADCAST_LANGUAGES else of, F.col("lang") == F.col("of")).drop("of")
    texts = chosen_landmarks(rows, languages, landmarks)
    marks = Landmarks.of(texts)
    # Nystroem: features k . M with M = K_mm^(-1/2); ridge regression on them, each language against the rest
    mm = marks.kernel(texts).astype(float)
    values, vectors = np.linalg.eigh((mm + mm.T) / 2)
    keep = values > 1e-6 * values.max()
    m = vectors[:, keep] / np.sqrt(values[keep])
    gram, names, of = normal_equations(rows.where(_draw() < per_language / F.col("n")), per_language, marks, m)
    target = (2 * of - of.sum(0)).T  # 1 for a language's own texts, -1 for the rest
    w = np.linalg.solve(gram + RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), target)
    return Model(names, marks, np.vstack([m @ w[:-1], w[-1:]]).astype(np.float32))


def identified(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(columns):
            if shared.value is None:
                return [columns[0], [UNKNOWN] * len(columns[0]), [0.0] * len(columns[0])]
            return [columns[0], *shared.value.predict(columns[1])]

        return work

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), "doc_id long, lang_pred string, score double", make)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", FOLDS) != HELD))
    return identified(docs, model).select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "lang_pred", "score")
