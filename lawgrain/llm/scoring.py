"""Language-model scores: a hashed maximum-entropy model over word classes.

A word's probability is factored: P(class | context) P(subclass | class, context)
P(word | its leaf class). The first two are softmaxes over hashed features of the words
before it (the last one, the last two together, and skips to the second and third last);
the last is the word's smoothed share in its leaf, so all known words and one unknown
word per leaf sum to one. Classes depend on a word's spelling alone.

A feature's value for a class is the log of how much more often the class follows it than
it occurs at all, from counts over all training texts, smoothed towards no difference. The
features' weights, one for each kind of feature and how often the feature was seen, maximise
the likelihood. Each round (one by default) is one synchronous update: every partition sums
gradient and curvature over all its training tokens, each token left out of its own counts,
and the sum of all partitions makes one Newton step. Counts, gradients and curvature are plain sums, so
the model is the same however the input is dealt. The tables grow with the input's bytes up
to `max_rows` rows, which bounds what is broadcast.

Word counts: a slice of texts sends each hash range its distinct words (64-bit hashes) with
their counts in training texts; the range sums them over all slices and sends each slice the
sums of its words back. Which text holds which word stays with the slice, and a frequent word
is one entry a slice. Ranges are as many as slices, so that one's words are about a slice's.

Defined results: a NULL or empty text is its end token alone; a NULL id is a training
document; ids keep their type; a repeated row counts, and is returned, as often as it occurs;
other columns are ignored; an empty table gives an empty table. Different words with one
64-bit hash (56 bits and the leaf) would count as one. A text is held whole by a task, with some thirty times its
bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.llm.texts import Texts, mix, slices
from lawgrain.session import staged

CLASSES, SUBCLASSES = 32, 8  # the last class holds the end token alone
LEAVES = CLASSES * SUBCLASSES
END = np.uint64(0x5851F42D4C957F00 | (LEAVES - SUBCLASSES))
# Kinds of features of each softmax; how often a feature must be seen for a weight of its own.
GROUP_KINDS, SUB_KINDS = 4, 2
SEEN = np.array([1, 8, 64])


@dataclass(frozen=True)
class LmParams:
    min_rows: int = 1 << 14
    max_rows: int = 1 << 17
    bytes_per_row: int = 256  # rows of each table by the texts' bytes
    smoothing: float = 4.0
    minibatch: int = 1 << 12
    rounds: int = 1
    weight_slices: int = 32
    fan_in: int = 16
    slice_bytes: int = 8 << 20
    min_ranges: int = 32
    rows: int = 0  # set from the input


def in_training(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


@dataclass
class Tokens:
    """Tokens of some texts, each text's end token included."""

    word: np.ndarray  # 64-bit hashes, the leaf in their last byte
    text: np.ndarray
    leaf: np.ndarray

    @staticmethod
    def of(texts: Texts) -> "Tokens":
        """Tokens of all texts; their words are hashed in small parts."""
        found, n = [], 0
        for part in texts.parts():
            tokens = Tokens._of_part(part)
            tokens.text += np.int32(n)
            found.append(tokens)
            n += len(part)
        return Tokens(*(np.concatenate([getattr(t, c) for t in found]) for c in ("word", "text", "leaf")))

    @staticmethod
    def _of_part(texts: Texts) -> "Tokens":
        words = texts.words()
        n, per = len(texts), np.diff(words.first_word)
        last = np.cumsum(per + 1) - 1
        total = int(per.sum()) + n
        solid = np.ones(total, bool)
        solid[last] = False
        word, leaf = np.full(total, END), np.full(total, LEAVES - SUBCLASSES, np.int16)
        word[solid] = words.hashes()
        if len(words):
            data, a, b = words.data.astype(np.uint32), words.start, words.end
            tail = data[b - 1] * np.uint32(31) + data[np.maximum(b - 2, a)]
            head = data[a] * np.uint32(7) + np.minimum(b - a, 12).astype(np.uint32)
            group = (tail * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(CLASSES - 1)
            sub = (head * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(SUBCLASSES)
            leaf[solid] = group * SUBCLASSES + sub
        # the last byte of a word's hash is its leaf
        word = word & ~np.uint64(255) | leaf.astype(np.uint64)
        return Tokens(word, np.repeat(np.arange(n, dtype=np.int32), per + 1), leaf)

    def features(self, at: slice, params: LmParams) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the two weight tables for the tokens in `at`: (feature, token)."""
        start = max(0, at.start - 3)
        word, text = self.word[start : at.stop], self.text[start : at.stop]
        skip = at.start - start

        def back(k: int) -> np.ndarray:
            out = np.zeros(len(word), np.uint64)
            if len(word) > k:
                out[k:] = np.where(text[k:] == text[:-k], word[:-k], np.uint64(0))
            return out[skip:]

        one, two, three = back(1), back(2), back(3)
        mask = np.uint64(params.rows - 1)
        rows = [one, mix(one ^ (two << np.uint64(1))), mix(two + np.uint64(2)), mix(three + np.uint64(3))]
        first = np.stack([(r & mask).astype(np.int32) for r in rows])
        group = (self.leaf[at] // SUBCLASSES).astype(np.uint64)
        near = mix(one + (group + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        far = mix(near ^ (two << np.uint64(1)))
        return first, np.stack([(r & mask).astype(np.int32) for r in (near, far)])


class Softmax:
    """One softmax over sums of weighted feature values, from the features' counts."""

    def __init__(self, counts: np.ndarray, kinds: int, smoothing: float):
        self.counts, self.smoothing = counts, np.float32(smoothing)
        whole = counts.sum(axis=0, dtype=np.float64)
        self.share = ((whole + 1) / (whole.sum() + len(whole))).astype(np.float32)
        seen = counts.sum(axis=1)
        value = counts.astype(np.float32)
        value += self.smoothing * self.share
        value /= (seen.astype(np.float32) + self.smoothing)[:, None] * self.share
        self.value = np.log(value, out=value)
        self.often = np.searchsorted(SEEN, seen, "right").astype(np.int8)  # 0: never
        self.weight = np.full((kinds, len(SEEN) + 1), 1.0 / kinds, np.float64)

    def _odds(self, rows: np.ndarray, values: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """Log odds of the classes, the greatest of a token being zero."""
        kinds = np.arange(len(rows))[:, None]
        weights = self.weight.astype(np.float32)[kinds, self.often[rows]]
        z = prior.copy()
        for w, v in zip(weights, values):
            z += w[:, None] * v
        z -= z.max(axis=1, keepdims=True)
        return z

    def log10(self, rows: np.ndarray, gold: np.ndarray, prior: np.ndarray) -> np.ndarray:
        z = self._odds(rows, (self.value.take(r, axis=0) for r in rows), prior)
        at = z.ravel().take(np.arange(len(gold)) * z.shape[1] + gold).astype(np.float64)
        return (at - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))) / np.log(10)

    def slope(self, rows: np.ndarray, gold: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the log-likelihood in the weights, tokens left out of their counts."""
        values, classes = [self.value.take(r, axis=0) for r in rows], prior.shape[1]
        own = np.arange(len(gold)) * classes + gold
        floor, gold_values = self.smoothing * self.share[gold], []
        for r, v in zip(rows, values):
            have = self.counts.ravel().take(r * np.int64(classes) + gold) + floor
            gold_values.append(v.ravel().take(own) + np.log(np.maximum(have - 1, 1e-6) / have).astype(np.float32))
            v.ravel()[own] = gold_values[-1]
        p = self._odds(rows, values, prior)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        mean = [np.einsum("nc,nc->n", p, v) for v in values]
        width, size = self.weight.shape[1], self.weight.size
        places = [kind * width + self.often[r].astype(np.int64) for kind, r in enumerate(rows)]
        gain, bend = np.zeros(size), np.zeros(size * size)
        for a, (v, m) in enumerate(zip(values, mean)):
            gain += np.bincount(places[a], gold_values[a] - m, size)
            part = p * v
            for b in range(a, len(rows)):
                both = np.einsum("nc,nc->n", part, values[b]) - m * mean[b]
                found = np.bincount(places[a] * size + places[b], both, size * size)
                bend += found
                if a != b:
                    bend += found.reshape(size, size).T.ravel()
        return gain, bend.reshape(size, size)

    def step(self, gain: np.ndarray, bend: np.ndarray) -> None:
        """One Newton step, held back where little was seen."""
        if not bend.any():
            return
        ridge = np.eye(len(gain)) * (1e-3 * np.trace(bend) / len(gain) + 1e-6)
        move = np.linalg.solve(bend + ridge, gain)
        self.weight = np.clip(self.weight + np.clip(move, -1, 1).reshape(self.weight.shape), -0.5, 2.0)


class Model:
    """Both softmaxes; `counts` has the features' classes, then their subclasses, then the leaves."""

    def __init__(self, params: LmParams, counts: np.ndarray, weights: list[np.ndarray] | None = None):
        self.params = params
        a, b = params.rows * CLASSES, params.rows * SUBCLASSES
        self.group = Softmax(counts[:a].reshape(-1, CLASSES), GROUP_KINDS, params.smoothing)
        self.sub = Softmax(counts[a : a + b].reshape(-1, SUBCLASSES), SUB_KINDS, params.smoothing)
        if weights is not None:
            self.group.weight, self.sub.weight = weights
        leaves = counts[a + b :].reshape(CLASSES, SUBCLASSES).astype(np.float64) + 0.5
        self.group_prior = np.log(leaves.sum(axis=1) / leaves.sum()).astype(np.float32)
        self.sub_prior = np.log(leaves / leaves.sum(axis=1, keepdims=True)).astype(np.float32)

    def parts(self, tokens: Tokens) -> Iterator[tuple]:
        """(slice, feature rows, classes, prior) of both softmaxes, some tokens at a time."""
        for at in range(0, len(tokens.word), self.params.minibatch):
            part = slice(at, min(at + self.params.minibatch, len(tokens.word)))
            first, second = tokens.features(part, self.params)
            group, sub = np.divmod(tokens.leaf[part], SUBCLASSES)
            yield part, (first, group, np.broadcast_to(self.group_prior, (len(group), CLASSES))), (second, sub, self.sub_prior[group])

    def slopes(self, tokens: Tokens) -> np.ndarray:
        """Gradients and curvatures of both softmaxes over some tokens, in one array."""
        sums: list = [0, 0, 0, 0]
        for _, group, sub in self.parts(tokens):
            sums = [x + y for x, y in zip(sums, (*self.group.slope(*group), *self.sub.slope(*sub)))]
        return np.concatenate([np.ravel(x) for x in sums])

    def step(self, flat: np.ndarray) -> None:
        at = 0
        for table in (self.group, self.sub):
            n = table.weight.size
            table.step(flat[at : at + n], flat[at + n : at + n + n * n].reshape(n, n))
            at += n + n * n

    def log10_class(self, tokens: Tokens) -> np.ndarray:
        """log10 of P(class) P(subclass) of each token."""
        out = np.zeros(len(tokens.word))
        for part, group, sub in self.parts(tokens):
            out[part] = self.group.log10(*group) + self.sub.log10(*sub)
        return out


def feature_counts(tokens: Tokens, params: LmParams, counts: np.ndarray) -> None:
    """Add the classes that follow each feature, and the leaves, to `counts`."""
    a, b = params.rows * CLASSES, params.rows * SUBCLASSES
    group_counts, sub_counts, leaves = counts[:a], counts[a : a + b], counts[a + b :]
    for at in range(0, len(tokens.word), 1 << 18):
        part = slice(at, at + (1 << 18))
        first, second = tokens.features(slice(at, min(at + (1 << 18), len(tokens.word))), params)
        group, sub = np.divmod(tokens.leaf[part].astype(np.int64), SUBCLASSES)
        for rows, width, own, table in ((first, CLASSES, group, group_counts), (second, SUBCLASSES, sub, sub_counts)):
            for r in rows:
                found, times = np.unique(r * np.int64(width) + own, return_counts=True)
                table[found] += times.astype(table.dtype)
        leaves += np.bincount(tokens.leaf[part], minlength=LEAVES).astype(leaves.dtype)


def _sums(rows: DataFrame) -> DataFrame:
    """Sums of the arrays of each key, streaming: one array a key in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, group, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = _long(values.as_py())
                if (part, group) in total:
                    total[part, group] += found
                else:
                    total[part, group] = found
        for (part, group), values in sorted(total.items()):
            yield _array_row(part, group, values)

    return rows.mapInArrow(run, "part long, grp long, data binary")


def _array_row(part: int, group: int, values: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part]), pa.array([group]), pa.array([_short(values)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "grp", "data"])


def count_features(rows: DataFrame, params: LmParams) -> np.ndarray:
    """Feature counts over all training texts: summed in groups of partitions, then whole."""
    size = params.rows * (CLASSES + SUBCLASSES) + LEAVES
    cuts = [size * k // params.weight_slices for k in range(params.weight_slices + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for _, texts in slices(batch, "text", params.slice_bytes):
                feature_counts(Tokens.of(texts), params, counts)
        if counts.any():
            group = TaskContext.get().partitionId() % params.fan_in
            for k in range(params.weight_slices):
                yield _array_row(k, group, counts[cuts[k] : cuts[k + 1]])

    counted = rows.where("training").select("text").mapInArrow(run, "part long, grp long, data binary")
    near = _sums(counted.repartition("part", "grp")).withColumn("grp", F.lit(0).cast("long"))
    counts = np.zeros(size, np.int64)
    for row in _sums(near.repartition("part")).toLocalIterator():
        counts[cuts[row["part"]] : cuts[row["part"] + 1]] = _long(row["data"])
    # beyond 32 bits a feature's shares no longer change
    return np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)


def train(rows: DataFrame, params: LmParams) -> tuple:
    """`rows` has training and text. Returns the broadcast counts and the weights."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(count_features(rows, params))
    model = Model(params, shared.value)
    for _ in range(params.rounds):
        weights = [model.group.weight, model.sub.weight]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model(params, shared.value, weights)
            total = None
            for batch in batches:
                for _, texts in slices(batch, "text", params.slice_bytes):
                    found = own.slopes(Tokens.of(texts))
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

        slopes = rows.where("training").select("text").mapInArrow(run, "at long, value double")
        found = slopes.groupBy("at").agg(F.sum("value").alias("value")).collect()  # some hundred rows
        if not found:
            break
        flat = np.zeros(len(found))
        for row in found:
            flat[row["at"]] = row["value"]
        model.step(flat)
    return shared, [model.group.weight, model.sub.weight]


_WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)


def _short(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as they need, behind a byte for the width."""
    code = min(k for k, t in enumerate(_WIDTHS) if int(values.max(initial=0)) <= np.iinfo(t).max)
    return bytes([code]) + values.astype(_WIDTHS[code]).tobytes()


def _long(blob: bytes) -> np.ndarray:
    """Reverse of `_short`, as 64-bit integers."""
    return np.frombuffer(blob, _WIDTHS[blob[0]], offset=1).astype(np.int64)


# A slice's own row (r NULL), and its words of each hash range with their training counts.
_BLOBS = ("words", "known", "training", "context", "n_tokens", "n_pairs", "leaf", "low", "high", "times")


def _slices(rows: DataFrame, params: LmParams, shared, weights: list[np.ndarray], ranges: int) -> DataFrame:
    """Per slice of texts: which text has which of its words, and its words by hash range."""
    kind = rows.schema["doc_id"].dataType
    fields = T._parse_datatype_string("slice bigint, r int, " + ", ".join(f"{n} binary" for n in _BLOBS)).fields
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(kind))])
    names, id_type = [f.name for f in schema.fields], to_arrow_type(kind)

    def table(number: int, r: list, ids: pa.Array, **blobs: list[bytes]) -> pa.RecordBatch:
        n = len(r)
        columns = [pa.array([number] * n, pa.int64()), pa.array(r, pa.int32())]
        columns += [pa.array(blobs.get(name, [None] * n), pa.binary()) for name in _BLOBS]
        return pa.RecordBatch.from_arrays([*columns, ids], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(params, shared.value, weights)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in slices(batch, "text", params.slice_bytes):
                tokens = Tokens.of(texts)
                n = len(texts)
                training = np.asarray(part.column(1).to_pylist(), bool)
                context = np.bincount(tokens.text, model.log10_class(tokens), n)
                order = np.argsort(tokens.word, kind="stable")
                word = tokens.word[order]
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                words = word[first]
                place = np.empty(len(word), np.int64)
                place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
                known = np.bincount(place, training[tokens.text], len(first)).astype(np.int64)
                pairs, times = np.unique(tokens.text * np.int64(len(first)) + place, return_counts=True)
                text, pair = np.divmod(pairs, len(first))
                # ascending within a text, so the high bytes come in runs
                ids = part.column(0).cast(id_type)
                yield table(
                    number,
                    [None],
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
                    training=[training.tobytes()],
                    context=[context.tobytes()],
                    n_tokens=[_short(np.bincount(tokens.text, minlength=n))],
                    n_pairs=[_short(np.bincount(text, minlength=n))],
                    leaf=[(words & np.uint64(LEAVES - 1)).astype(np.uint8).tobytes()],
                    low=[(pair & 0xFFFF).astype(np.uint16).tobytes()],
                    high=[_short(pair >> 16)],
                    times=[_short(times)],
                )
                # ranges that have words; never more rows than words
                of = ((words >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                at = np.flatnonzero(np.diff(of, prepend=-1))
                parts = [slice(a, b) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(of)])]
                yield table(
                    number,
                    of[at].tolist(),
                    pa.nulls(len(parts), pa.list_(id_type)),
                    words=[words[p].tobytes() for p in parts],
                    known=[_short(known[p]) for p in parts],
                )
                number += 1

    return rows.mapInArrow(run, schema)


def _add_up(table: pa.Table) -> pa.Table:
    """One hash range: the sums of its words for each slice, and each leaf's sums (slice -1)."""
    r = table.column("r")[0].as_py()
    numbers = table.column("slice").to_pylist()
    words = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
    known = [_long(x) for x in table.column("known").to_pylist()]
    distinct, inverse = np.unique(np.concatenate(words), return_inverse=True)
    totals = np.bincount(inverse, np.concatenate(known), len(distinct)).astype(np.int64)
    leaf = (distinct & np.uint64(LEAVES - 1)).astype(np.int64)
    sums = np.concatenate([np.bincount(leaf, x, LEAVES) for x in (totals, totals > 0)]).astype(np.int64)
    out, at = [sums.tobytes()], 0
    for own in words:
        out.append(_short(totals[inverse[at : at + len(own)]]))
        at += len(own)
    columns = [pa.array([-1, *numbers], pa.int64()), pa.array([r] * len(out), pa.int32()), pa.array(out, pa.binary())]
    return pa.table(columns, names=["slice", "r", "totals"])


def _leaf_sums(summed: DataFrame) -> np.ndarray:
    """Training tokens and known words of each leaf: (2, LEAVES)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * LEAVES, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                total += np.frombuffer(blob.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "n"])

    per_task = summed.where("slice = -1").select("totals").mapInArrow(run, "at long, n long")
    out = np.zeros(2 * LEAVES, np.int64)
    for row in per_task.groupBy("at").agg(F.sum("n").alias("n")).collect():  # 2 * LEAVES rows
        out[row["at"]] = row["n"]
    return out.reshape(2, LEAVES)


_RESULT = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(
    docs: DataFrame, params: LmParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    params = params or LmParams()
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        in_training(docs[id_col]).alias("training"),
        docs[text_col].cast("string").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = 1 << max(0, int(size) // params.bytes_per_row - 1).bit_length()
    params = replace(params, rows=min(params.max_rows, max(params.min_rows, wanted)))
    shared, weights = train(rows, params)
    ranges = max(params.min_ranges, int(size) // params.slice_bytes)
    stored = staged(_slices(rows, params, shared, weights, ranges), "lm")
    sent = stored.where("r IS NOT NULL").select("r", "slice", "words", "known")
    summed = staged(sent.groupBy("r").applyInArrow(_add_up, "slice long, r int, totals binary"), "lm-words")
    leaf_tokens, leaf_words = _leaf_sums(summed)
    train_tokens, vocabulary = int(leaf_tokens.sum()), int(leaf_words.sum())
    leaf_log, base_log = np.log10(leaf_tokens + leaf_words + 1.0), np.log10(train_tokens + vocabulary + 1)
    answers = summed.where("slice >= 0").groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("r", "totals"))).alias("answer"))
    fields = [T.StructField("doc_id", rows.schema["doc_id"].dataType), *T._parse_datatype_string(_RESULT).fields]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                have = {n: batch.column(n)[i].as_py() for n in ("training", "context", "n_tokens", "n_pairs", "leaf", "low", "high", "times", "totals")}
                totals = np.concatenate([_long(x) for x in have["totals"]])
                leaf = np.frombuffer(have["leaf"], np.uint8)
                pair = _long(have["high"]) << 16 | np.frombuffer(have["low"], np.uint16)
                tokens, times = _long(have["n_tokens"]), _long(have["times"])
                n = len(tokens)
                text = np.repeat(np.arange(n), _long(have["n_pairs"]))
                logs = np.bincount(text, times * np.log10(totals + 1)[pair], n)
                known = np.bincount(text, times * (totals > 0)[pair], n).astype(np.int64)
                spread = np.bincount(text, times * leaf_log[leaf][pair], n)
                numbers = [
                    pa.array(~np.frombuffer(have["training"], bool)),
                    pa.array(tokens),
                    pa.array(known),
                    pa.array(np.full(n, train_tokens)),
                    pa.array(logs - tokens * base_log),
                    pa.array(logs + np.frombuffer(have["context"]) - spread),
                ]
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, *numbers], names=[f.name for f in fields])

    own = stored.where("r IS NULL").drop("r", "words", "known")
    joined = own.join(answers.select("slice", F.col("answer.totals").alias("totals")), "slice").drop("slice")
    return joined.mapInArrow(finish, T.StructType(fields))
