"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Each sentence has a probability, logistic in the weights of its words and of their
beginnings; the document's
is their noisy-or, 1 - prod(1 - p). Both the training (labels exist for documents only)
and the scores go through it, and the sentences behind a score are located.

Training takes at most `sample_docs` labelled documents, those whose ids hash lowest, and
of them, in that order, no more than `sample_bytes` of text, texts over `sample_text_bytes`
left out (they are scored whole like all others). It keeps the words whose document frequencies among toxic and other documents differ
by `min_z` standard errors. Labels, languages, sources and ids are no inputs of a score.

Defined results: NULL or empty texts have no sentence and score 0; a repeated row gives
a repeated result (one row of an id is trained on, whatever the number); repeated labels of a document count as toxic if one is; NULL labels
and labels of unknown documents are not used; without a toxic training document every
score is 0; an empty table gives an empty table; ids keep their type.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawgrain.llm.samples import least_hashes
from lawgrain.llm.texts import Texts, Words, run_hashes, slices

# Features of a word: itself and its first bytes, so that inflected forms share weight.
PREFIXES = (4, 5, 6)
FEATURES = 1 + len(PREFIXES)
_BREAK = np.zeros(256, np.int64)
_BREAK[[ord(c) for c in ".!?\n"]] = 1


@dataclass(frozen=True)
class ToxicityParams:
    sample_docs: int = 5_000
    sample_bytes: int = 32 << 20
    sample_text_bytes: int = 1 << 20
    buckets: int = 1 << 18
    min_docs: int = 5
    min_z: float = 4.0
    epochs: int = 300
    penalty: float = 1e-4
    threshold: float = 0.3


def sentence_of(words: Words) -> np.ndarray:
    """A number for each word that changes with its sentence and its text."""
    breaks = np.concatenate(([0], np.cumsum(_BREAK[words.data])))[words.start] if len(words) else np.zeros(0, int)
    new = np.zeros(len(words), bool)
    if len(words):
        new[1:] = (np.diff(breaks) > 0) | (np.diff(words.text_of()) > 0)
    return np.cumsum(new)


@dataclass
class Bags:
    """Features of many texts, FEATURES a word: bucket and sentence; text of each sentence."""

    bucket: np.ndarray
    sentence: np.ndarray
    text: np.ndarray

    @staticmethod
    def of(texts: Texts, buckets: int) -> tuple["Bags", Words]:
        words = texts.tokens()
        sentence = sentence_of(words)
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        hashes = [words.hashes()]
        for n in PREFIXES:
            hashes.append(run_hashes(words.data, words.start, np.minimum(words.start + n, words.end)) + np.uint64(n))
        bucket = (np.column_stack(hashes).ravel() & np.uint64(buckets - 1)).astype(np.int64)
        return Bags(bucket, np.repeat(sentence, FEATURES), words.text_of()[first]), words


@dataclass
class Model:
    bias: float
    weight: np.ndarray  # per bucket

    def sentences(self, bags: Bags) -> np.ndarray:
        """log(1 - p) of every sentence."""
        value = self.weight[bags.bucket]
        at = np.flatnonzero(value)
        z = self.bias + np.bincount(bags.sentence[at], value[at], len(bags.text))
        return -np.logaddexp(0, z)

    def documents(self, bags: Bags, n: int) -> np.ndarray:
        return -np.expm1(np.bincount(bags.text, self.sentences(bags), n))


def train(docs: list[tuple[int, np.ndarray, np.ndarray]], params: ToxicityParams) -> Model:
    """Noisy-or likelihood by Adam on the whole sample.

    Rows of a label, the buckets of each word and the sentence of each word.
    """
    weight = np.zeros(params.buckets)
    toxic = np.array([d[0] for d in docs], float)
    if not len(docs) or not toxic.any():
        return Model(-np.inf, weight)
    positive, negative = np.zeros(params.buckets), np.zeros(params.buckets)
    for label, bucket, _ in docs:
        (positive if label else negative)[np.unique(bucket)] += 1
    n_pos, n_neg = toxic.sum(), max(1.0, len(docs) - toxic.sum())
    p, q = (positive + 0.5) / (n_pos + 1), (negative + 0.5) / (n_neg + 1)
    error = np.sqrt(p * (1 - p).clip(1e-9) / n_pos + q * (1 - q).clip(1e-9) / n_neg)
    chosen = (positive + negative >= params.min_docs) & (np.abs(p - q) >= params.min_z * error)
    features = np.flatnonzero(chosen)
    place = np.full(params.buckets, -1, np.int32)
    place[features] = np.arange(len(features))
    feat, sent, text, n_sent = [], [], [], 0
    for i, (_, bucket, sentence) in enumerate(docs):
        known = place[bucket]
        use = known >= 0
        feat.append(known[use])
        sent.append(np.repeat(sentence, FEATURES)[use] + n_sent)
        count = int(sentence[-1]) + 1 if len(sentence) else 0
        text.append(np.full(count, i))
        n_sent += count
    feat, sent, text = map(np.concatenate, (feat, sent, text))
    theta = np.zeros(len(features) + 1)
    theta[-1] = -7.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, params.epochs + 1):
        z = theta[-1] + np.bincount(sent, theta[feat], n_sent)
        p_sent = 1 / (1 + np.exp(-z))
        survive = np.bincount(text, -np.logaddexp(0, z), len(docs))
        p_doc = -np.expm1(survive)
        # d loss / d z of a sentence: p for a clean text, -p * (1 - P) / P for a toxic one
        factor = np.where(toxic > 0, -np.exp(survive) / np.maximum(p_doc, 1e-12), 1.0)
        dz = p_sent * factor[text] / len(docs)
        grad = np.concatenate((np.bincount(feat, dz[sent], len(features)), [dz.sum()]))
        grad[:-1] += params.penalty * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    weight[features] = theta[:-1]
    return Model(float(theta[-1]), weight)


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams, id_col: str, text_col: str) -> DataFrame:
    """toxic and text of the training documents, one row an id, within all three bounds.

    What goes to the driver and is broadcast to the joins are ids, at most `sample_docs`.
    """
    kind = docs.schema[id_col].dataType
    chosen = (
        labels.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & in_training(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = least_hashes(chosen, F.col("doc_id"), params.sample_docs)
    texts = docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    ).withColumn("copy", F.xxhash64("text"))
    sizes = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct("copy", F.octet_length("text").alias("size"))).alias("first"))
        .select("doc_id", "toxic", "first.*", F.xxhash64("doc_id").alias("place"))
    )
    taken, total = [], 0
    for row in sorted(sizes.collect(), key=lambda r: (r["place"], str(r["doc_id"]))):
        if row["size"] > params.sample_text_bytes:
            continue
        total += row["size"]
        if total > params.sample_bytes:
            break
        taken.append((row["doc_id"], row["toxic"], row["copy"]))
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("toxic", T.IntegerType()), T.StructField("copy", T.LongType())]
    )
    wanted = F.broadcast(docs.sparkSession.createDataFrame(taken, schema))
    return texts.join(wanted, ["doc_id", "copy"]).dropDuplicates(["doc_id"]).select("toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams, id_col: str, text_col: str) -> Model:
    """The model of a bounded sample of labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                bags, words = Bags.of(texts, params.buckets)
                first, sentence = words.first_word, bags.sentence[::FEATURES]
                rows = [
                    (
                        bags.bucket[a * FEATURES : b * FEATURES].astype(np.int32),
                        (sentence[a:b] - sentence[a : a + 1]).astype(np.int32),
                    )
                    for a, b in zip(first[:-1], first[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1))],
                    names=["toxic", "buckets", "sentences"],
                )

    chosen = sample(docs, labels, params, id_col, text_col)
    rows = chosen.mapInArrow(run, "toxic int, buckets binary, sentences binary").collect()
    return train(
        sorted(
            ((r["toxic"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["sentences"], np.int32)) for r in rows),
            key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()),
        ),
        params,
    )


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    params: ToxicityParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, score, predicted and the offending sentences of every document.

    `offending` holds start and end (code points) and probability of each sentence
    that alone reaches the threshold.
    """
    params = params or ToxicityParams()
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params, id_col, text_col))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                bags, words = Bags.of(texts, params.buckets)
                p = -np.expm1(model.sentences(bags))
                offending: list[list[dict]] = [[] for _ in range(len(texts))]
                worst = np.flatnonzero(p >= params.threshold)
                if len(worst):
                    points = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
                    sentence = bags.sentence[::FEATURES]
                    begin = words.start[np.searchsorted(sentence, worst, "left")]
                    end = words.end[np.searchsorted(sentence, worst, "right") - 1]
                    for s, a, b in zip(worst.tolist(), begin.tolist(), end.tolist()):
                        base = points[texts.offsets[bags.text[s]]]
                        offending[bags.text[s]].append(
                            {"start": int(points[a] - base), "end": int(points[b] - base), "p": float(p[s])}
                        )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.documents(bags, len(texts))), pa.array(offending, span)],
                    names=["doc_id", "score", "offending"],
                )

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(
        run, f"doc_id {kind}, score double, offending array<struct<start:long,end:long,p:double>>"
    )
    return out.withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))
