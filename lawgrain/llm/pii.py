"""Personal data: base patterns, and a skip-chain conditional random field.

Base spans are those of the patterns and checks of `base_spans`; they always stay. The
field then labels, in each document, the other pieces that could be personal data: words
with an @ or seven digits and more, and runs of digit groups. Where some groups of a run
are the end of a number that the document's base spans hold (a leading zero aside), they
are a piece of their own. Its nodes are the base spans (their labels are known) and
these pieces. Neighbouring nodes share a chain potential; nodes with the same or similar
content (the same letters and digits, the same last seven digits, the same name before
an @) share a skip potential, linked from one occurrence to the next, so that a group
costs a link per member. Loopy sum-product messages give each piece's marginals, and a
piece whose best label is surer than `min_marginal` becomes a span.

All weights are trained by pseudo-likelihood. Labels are the base spans' kinds and "other"
for the rest. So that the field learns to find repeats and not to deny them, half of the
base contents are restated in a form the base patterns do not find (without the country
code, with other separators, without the domain's end), once as they are, with their label,
and once with other digits or letters, labelled "other", in each form by itself: only links tell the two apart.
Equal nodes (features, label and labels around) of all documents are counted together, and
training takes at most `sample_examples` of these distinct ones, by hash. Pieces that links
join to a base span have no label there.

Defined results: a NULL or empty text has no spans; a repeated row gives a repeated
result; an empty table gives an empty table; ids keep their type. Pieces that
overlap are taken from the left, base spans before digit groups before words. Offsets count code points, ends excluded.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawgrain.llm.samples import least_hashes
from lawgrain.llm.texts import slices
from lawgrain.session import staged

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
FORMS = 4  # ways in which a number is restated

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A digit before cannot start an earlier match: greedy runs are never cut short.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"(?<![^ \t-\r])[^ \t-\r0-9@]*+[0-9@][^ \t-\r]*+")
_DIGIT = re.compile("[0-9]")
_SOLID = re.compile("[^a-z0-9]+")
_RUN = re.compile(r"(?<![A-Za-z0-9@])[0-9]++(?:[ ()./-]{1,3}[0-9]++)++")
_GROUP = re.compile("[0-9]+")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*range(48, 58), ord("@")]] = True


@dataclass(frozen=True)
class PiiParams:
    sample_examples: int = 10_000  # distinct nodes that the field is trained on
    features: int = 1 << 12
    epochs: int = 500
    rounds: int = 12
    min_marginal: float = 0.9
    chain_words: int = 40  # nodes further apart (code points) share no chain potential


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        done = found.end() if found else at + 1
        if found:
            yield begin, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    spans = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


def _digits(surface: str) -> str:
    return "".join(_DIGIT.findall(surface))


def number_pieces(text: str, begin: int, end: int, known: set[str]) -> list[tuple[int, int]]:
    """Pieces of the digit-group runs between two places.

    Groups whose digits are in `known`, the leftmost and then longest first; a run
    without them is a piece if it has 7 to 19 digits, none of its groups over 6.
    """
    found = []
    for run in _RUN.finditer(text, begin, end):
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]
        i, like = 0, len(found)
        while i < len(groups):
            digits, stop = "", 0
            for j in range(i, len(groups)):
                digits += text[groups[j][0] : groups[j][1]]
                if len(digits) > 20:
                    break
                if digits in known or (digits[0] == "0" and digits[1:] in known):
                    stop = j + 1
            if stop:
                found.append((groups[i][0], groups[stop - 1][1]))
            i = stop or i + 1
        if len(found) == like and 7 <= sum(b - a for a, b in groups) <= 19 and max(b - a for a, b in groups) < 7:
            found.append((run.start(), run.end()))
    return [(a - 1 if a > begin and text[a - 1] == "(" and ")" in text[a:b] else a, b) for a, b in found]


def nodes(text: str) -> list[tuple[int, int, int, str]]:
    """(label, start, end, surface) of base spans and other candidate pieces, by start."""
    spans = base_spans(text)
    found = [(k, a, b, text[a:b]) for k, a, b in spans]
    numbers = [_digits(surface) for k, _, _, surface in found if k >= 2]
    known = {d[i:] for d in numbers for i in range(len(d) - 6)}
    free, done = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if a > done:
            free.append((done, a))
        done = max(done, b)
    free.append((done, len(text)))
    pieces = [p for a, b in free for p in number_pieces(text, a, b, known)]
    found += [(OTHER, a, b, text[a:b]) for a, b in pieces]
    covered = sorted([(a, b) for _, a, b in spans] + pieces)
    at = 0
    for m in _WORD.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at < len(covered) and covered[at][0] < m.end():
            continue
        word = m[0].strip(".,;:!?()[]<>\"'")
        if "@" in word or len(_DIGIT.findall(word)) >= 7:
            begin = m.start() + m[0].index(word)
            found.append((OTHER, begin, begin + len(word), word))
    return sorted(found, key=lambda n: n[1:3] + n[:1])


def restated(kind: int, surface: str, form: int, same: bool = True) -> str | None:
    """A span's content written as no base pattern finds it; with other signs if not `same`.

    None for addresses of machines, which have one form.
    """
    if kind == 1:
        return None
    if kind == 0:
        local, _, host = surface.partition("@")
        if not same:
            local = "".join(chr((ord(c) - 97 + 7 + i) % 26 + 97) if c.isalpha() else c for i, c in enumerate(local.lower()))
        return f"{local}@{host.partition('.')[0]}"
    digits = _digits(surface)
    if not same:
        digits = "".join(str((int(d) + 3 + i * i) % 10) for i, d in enumerate(digits))
    if kind == 2:
        return "./"[form % 2].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = digits[-10:] if len(digits) > 10 else digits[1:]
    area, middle, last = digits[:-7], digits[-7:-4], digits[-4:]
    return (f"{area} {middle} {last}", f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}")[form % 4]


def with_restated(
    labels: list[int], starts: list[int], ends: list[int], surfaces: list[str], form: int, params: PiiParams
):
    """A document's nodes, followed by half of its base contents restated in a form, far away."""
    labels, starts, ends, surfaces = list(labels), list(starts), list(ends), list(surfaces)
    at, seen = max(ends, default=0), set()
    for label, surface in list(zip(labels, surfaces)):
        if label == OTHER or zlib.crc32(surface.encode()) & 1 or (label, surface) in seen:
            continue
        seen.add((label, surface))
        for same in (True, False):
            other = restated(label, surface, form, same)
            if other is not None:
                at += params.chain_words + 1
                labels.append(label if same else OTHER)
                starts.append(at)
                ends.append(at + len(other))
                surfaces.append(other)
                at += len(other)
    return labels, starts, ends, surfaces


def features(surface: str, width: int) -> list[int]:
    """Hashed features of a node's own text."""
    digits = _digits(surface)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", "9", surface))[:24]
    letters = sum(c.isalpha() for c in surface)
    parts = surface.split(".")
    flags = [
        "bias",
        f"shape {shape}",
        f"digits {min(len(digits), 20)}",
        f"letters {min(letters, 8)}",
        f"at {surface.count('@')}",
        f"dots {min(surface.count('.'), 5)}",
        f"plus {surface[:1] == '+'}",
        f"luhn {13 <= len(digits) <= 19 and luhn(digits)} {letters > 0}",
        f"ip {len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts)}",
    ]
    return [zlib.crc32(f.encode()) % width for f in flags]


def links(starts: list[int], ends: list[int], surfaces: list[str], reach: int) -> list[tuple[int, int, int]]:
    """(i, j, type) with type 0 for the chain and 1 for skips between like nodes."""
    found = [(i, i + 1, 0) for i in range(len(starts) - 1) if starts[i + 1] - ends[i] <= reach]
    last: dict[str, int] = {}
    for i, surface in enumerate(surfaces):
        keys = ["=" + _SOLID.sub("", surface.lower())]
        digits = _digits(surface)
        local, at, _ = surface.lower().partition("@")
        if at and len(local) > 2:
            keys.append("@" + local)
        if len(digits) >= 7 and not at:
            keys.append("#" + digits[-7:])
        linked = {last[k] for k in keys if k in last}
        found += [(j, i, 1) for j in sorted(linked)]
        last.update((k, i) for k in keys)
    return found


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    pair: np.ndarray  # type x label x label, symmetric

    def marginals(self, labels: list[int], feats: list[list[int]], edges: list[tuple[int, int, int]], rounds: int) -> np.ndarray:
        """Label probabilities of each node; labels below OTHER are known."""
        local = np.stack([self.unary[f].sum(axis=0) for f in feats])
        for i, label in enumerate(labels):
            if label != OTHER:
                local[i] = -50.0
                local[i, label] = 0.0
        if edges:
            e = np.array(edges)
            source, target = np.concatenate((e[:, 0], e[:, 1])), np.concatenate((e[:, 1], e[:, 0]))
            weight = self.pair[np.concatenate((e[:, 2], e[:, 2]))]
            back = np.concatenate((np.arange(len(e), 2 * len(e)), np.arange(len(e))))
            messages = np.zeros((2 * len(e), OTHER + 1))
            for _ in range(rounds):
                belief = local.copy()
                np.add.at(belief, target, messages)
                out = (belief[source] - messages[back])[:, :, None] + weight
                top = out.max(axis=1, keepdims=True)
                new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
                messages = 0.5 * messages + 0.5 * (new - new.max(axis=1, keepdims=True))
            belief = local.copy()
            np.add.at(belief, target, messages)
        else:
            belief = local
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def added(self, labels, starts, ends, surfaces, params: PiiParams) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the words that the field labels."""
        if OTHER not in labels:
            return []
        marginals = self.marginals(
            labels,
            [features(s, params.features) for s in surfaces],
            links(starts, ends, surfaces, params.chain_words),
            params.rounds,
        )
        best = marginals.argmax(axis=1)
        return [
            (int(best[i]), starts[i], ends[i])
            for i, label in enumerate(labels)
            if label == OTHER and best[i] != OTHER and marginals[i, best[i]] >= params.min_marginal
        ]


def examples(labels, starts, ends, surfaces, params: PiiParams, since: int | None = None) -> list[tuple[tuple, int, tuple]]:
    """(features, label, linked labels) of each node; the last is a count per link type and label.

    Pieces that skip links lead to from a base span are what the field is to find: their
    label is not known, and neither they nor their links are examples. With `since`, nodes
    from that number on are known, and they alone are returned.
    """
    width = OTHER + 1
    first, certain = (0, len(labels)) if since is None else (since, since)
    edges = links(starts, ends, surfaces, params.chain_words)
    group = list(range(len(labels)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i, j, kind in edges:
        if kind == 1:
            group[root(j)] = root(i)
    touched = {root(i) for i, label in enumerate(labels) if label != OTHER}
    sure = [i >= certain or label != OTHER or root(i) not in touched for i, label in enumerate(labels)]
    around = np.zeros((len(labels), 2 * width), int)
    for i, j, kind in edges:
        if sure[i] and sure[j]:
            around[i, kind * width + labels[j]] += 1
            around[j, kind * width + labels[i]] += 1
    return [
        (tuple(features(s, params.features)), label, tuple(near))
        for s, label, near, known in list(zip(surfaces, labels, around.tolist(), sure))[first:]
        if known
    ]


def train(samples: list[tuple[list[int], list[int], list[int], list[str]]], params: PiiParams) -> Field:
    """The field of the nodes of some documents."""
    return learn([(e, 1.0) for sample in samples for e in examples(*sample, params)], params)


def learn(weighted: list[tuple[tuple[tuple, int, tuple], float]], params: PiiParams) -> Field:
    """Pseudo-likelihood: each node's label given its features and linked labels.

    Accelerated full gradients over the weighted examples, with a small quadratic penalty.
    """
    width = OTHER + 1
    unary, pair = np.zeros((params.features, width)), np.zeros((2, width, width))
    if not weighted:
        return Field(unary, pair)
    x = np.array([e[0] for e, _ in weighted])
    target = np.eye(width)[[e[1] for e, _ in weighted]]
    around = np.array([e[2] for e, _ in weighted], float).reshape(-1, 2, width)
    weight = np.array([w for _, w in weighted])
    weight = (weight / weight.sum())[:, None]
    flat = x.ravel()
    speed_u, speed_p = np.zeros_like(unary), np.zeros_like(pair)
    for _ in range(params.epochs):
        score = unary[x].sum(axis=1) + np.einsum("nkl,klm->nm", around, pair)
        score = np.exp(score - score.max(axis=1, keepdims=True))
        error = (score / score.sum(axis=1, keepdims=True) - target) * weight
        grad_u = np.zeros_like(unary)
        np.add.at(grad_u, flat, np.repeat(error, x.shape[1], axis=0))
        grad_p = np.einsum("nkl,nm->klm", around, error)
        grad_p = (grad_p + grad_p.transpose(0, 2, 1)) / 2
        speed_u = 0.9 * speed_u + grad_u + 1e-4 * unary
        speed_p = 0.9 * speed_p + grad_p + 1e-4 * pair
        unary -= 0.3 * speed_u
        pair -= 0.3 * speed_p
    return Field(unary, pair)


_NODE = "array<struct<kind:int,start:long,end:long,surface:string>>"


def document_nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the field's nodes of every document, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("surface", pa.string())])
        )
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hits = np.concatenate(([0], np.cumsum(_TRIGGER[texts.data])))[texts.offsets]
                found: list[list] = [[] for _ in range(len(texts))]
                for i in np.flatnonzero(np.diff(hits)).tolist():
                    found[i] = [
                        dict(zip(("kind", "start", "end", "surface"), n))
                        for n in nodes(texts.bytes(i).decode("utf-8", "replace"))
                    ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "nodes"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {_id_type(rows)}, nodes {_NODE}")


def _id_type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def _unpack(row_nodes: list) -> tuple[list[int], list[int], list[int], list[str]]:
    return tuple([n[k] for n in row_nodes] for k in ("kind", "start", "end", "surface"))


def fit(table: DataFrame, params: PiiParams) -> Field:
    """The field, from the distinct examples of all documents whose hash is least.

    Equal features that are met n times weigh 1 + ln n, shared among their examples by number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = Counter()
            for row in batch.column(0).to_pylist():
                plain = _unpack(row)
                met.update(examples(*plain, params))
                for form in range(FORMS if min(plain[0]) < OTHER else 0):
                    met.update(examples(*with_restated(*plain, form, params), params, since=len(row)))
            columns = [[e[k] for e in met] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.list_(pa.int32())),
                    pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.list_(pa.int32())),
                    pa.array(met.values(), pa.int64()),
                ],
                names=["features", "label", "around", "n"],
            )

    found = table.where(F.size("nodes") > 0).select("nodes")
    found = found.mapInArrow(run, "features array<int>, label int, around array<int>, n long")
    found = staged(found.groupBy("features", "label", "around").agg(F.sum("n").alias("n")), "pii-examples")
    key = F.struct("features", "label", "around")
    rows = least_hashes(found, key, params.sample_examples).collect()
    met = Counter()
    for r in rows:
        met[tuple(r["features"])] += r["n"]
    return learn(
        [
            ((own, r["label"], tuple(r["around"])), r["n"] / met[own] * (1.0 + math.log(met[own])))
            for r in rows
            for own in [tuple(r["features"])]
        ],
        params,
    )


def find_personal_data(
    docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, base and spans (both arrays of kind, start, end) of every document."""
    params = params or PiiParams()
    table = staged(document_nodes(docs, id_col, text_col), "pii")
    field = docs.sparkSession.sparkContext.broadcast(fit(table, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            base, spans = [], []
            for row in batch.column(1).to_pylist():
                labels, starts, ends, surfaces = _unpack(row)
                known = sorted(t for t in zip(labels, starts, ends) if t[0] != OTHER)
                more = field.value.added(labels, starts, ends, surfaces, params) if row else []
                for out, these in ((base, known), (spans, sorted(known + more))):
                    out.append([{"kind": k, "start": a, "end": b} for k, a, b in these])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, kind), pa.array(spans, kind)], names=["doc_id", "base", "spans"]
            )

    span = "array<struct<kind:int,start:long,end:long>>"
    return table.mapInArrow(run, f"doc_id {_id_type(table)}, base {span}, spans {span}")


def redact(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; `n_chars`, if there,
    follows the new text. NULL texts stay NULL."""
    params = params or PiiParams()
    table = staged(document_nodes(docs, id_col, text_col), "pii")
    field = docs.sparkSession.sparkContext.broadcast(fit(table, params))

    def clean(text: str) -> str:
        labels, starts, ends, surfaces = _unpack([dict(zip(("kind", "start", "end", "surface"), n)) for n in nodes(text)])
        spans = [t for t in zip(labels, starts, ends) if t[0] != OTHER]
        spans += field.value.added(labels, starts, ends, surfaces, params)
        out, at = [], 0
        for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if begin >= at:
                out += [text[at:begin], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.schema.get_field_index(text_col)
            for part, texts in slices(batch, text_col):
                hits = np.concatenate(([0], np.cumsum(_TRIGGER[texts.data])))[texts.offsets]
                touched = np.flatnonzero(np.diff(hits)).tolist()
                if touched:
                    new = part.column(column).to_pylist()
                    for i in touched:
                        new[i] = clean(new[i])
                    part = part.set_column(column, part.schema.field(column), pa.array(new, part.schema.field(column).type))
                yield part

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def joined(spans: str) -> "F.Column":
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def counts(spans: str) -> list["F.Column"]:
    def count(kind: int):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
