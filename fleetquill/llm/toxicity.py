"""Toxicity by a support vector machine on a gap-tolerant string kernel.

A unit is a short stretch of text. Its features are all subsequences of three symbols whose
first symbol is among the unit's first ``STARTS`` and which span at most ``SPAN`` symbols; one
that spans s counts ``DECAY ** s``. The kernel of two units is the product of these vectors,
so a word written with characters put in between stays near its plain form. Landmark units give the
Nyström map K(u, L) K(L, L)^(-1/2), on which a linear machine with squared hinge loss is
trained. As the features are explicit, landmarks and weights fold into one weight per
subsequence and a text of any length is scored exactly, every unit of it, in one scan. A
text's score follows from its most toxic unit and from how many units are on the toxic side,
as a number and against its length, by a logistic fit.

Only texts carry labels, so a toxic text stands for its most telling unit, a clean one for
all of its units: the machine is trained again with the clean units it took for toxic. The
sample of labelled texts is bounded: at most ``per_class`` texts of each class, each of at
most ``max_bytes`` bytes. Half of it trains, half sets threshold and scale. A toxic text
gives at most ``UNITS_OF_TEXT`` units, the first by place, each also with gaps at the rates in
``GAPS``; the clean ones give about ``NEGATIVE_UNITS``, one a text at least, and two a text in
each of ``ROUNDS`` rounds. Landmarks are 120 toxic and 80 clean units, and for every gram that
tells toxic texts one unit that holds it; the grams' number follows the texts.

Defined results: a null or empty text has no unit and is not toxic; labels that are null or
neither 0 nor 1 teach nothing, a doc_id with both labels is toxic; without texts of both classes every
score is 0; repeated rows are scored each; an empty table gives an empty table; other
columns are kept, but for one named like the result, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill.llm import shared

SYMBOLS = 64
STARTS = 6
SPAN = 6
DECAY = 0.6
GRAMS = (4, 6)
BLOCK = 1 << 20
PATTERNS = [(a, a + b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
PER_CLASS = 2000
MAX_BYTES = 32_768
ROUNDS = 3
NEGATIVE_UNITS = 10_000
GAPS = (0.25, 0.6, 1.0)
UNITS_OF_TEXT = 20
ROWS = 4096
RIDGE = 1e-4
EMPTY = -10.0


def symbol_table() -> np.ndarray:
    """Letters without case are 1 to 26, other ASCII is 0; bytes of longer characters keep
    what tells them apart but for case."""
    table = np.zeros(256, np.int32)
    for k in range(26):
        table[ord("a") + k] = table[ord("A") + k] = 1 + k
    for byte in range(0x80, 0xC0):
        table[byte] = 27 + (byte & 31)
    for byte in range(0xC0, 256):
        table[byte] = 59 + (byte & 3)
    return table


SYMBOL = symbol_table()


@dataclass
class Model:
    weight: np.ndarray  # of every subsequence of three symbols
    bias: float
    blend: np.ndarray  # weights of a text's features, the last without one
    threshold: float
    scale: float

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        features = text_features(data, offsets, self.weight, self.bias)
        return self.scale * (features @ self.blend[:-1] + self.blend[-1] - self.threshold)


def unit_codes(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of the units that start at ``at`` and their weights; both [unit, STARTS * patterns].
    The symbols have to go on for STARTS + SPAN beyond every start."""
    codes, weights = [], []
    for start in range(STARTS):
        for middle, last in PATTERNS:
            i = at + start
            codes.append((symbols[i] * SYMBOLS + symbols[i + middle]) * SYMBOLS + symbols[i + last])
            weights.append(DECAY ** (last + 1))
    return np.stack(codes, axis=1), np.array(weights, np.float32)


def unit_scores(symbols: np.ndarray, offsets: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For every symbol the weighted sum of the unit that starts there; units end with
    their text."""
    total = np.zeros(len(symbols), np.float32)
    high, low = symbols << 12, symbols << 6
    starts, ends = offsets[:-1], offsets[1:]
    by_span = {s: (weight * DECAY**s).astype(np.float32) for s in range(3, SPAN + 1)}
    for middle, last in PATTERNS:
        n = len(symbols) - last
        if n <= 0:
            continue
        part = by_span[last + 1][high[:n] + low[middle : middle + n] + symbols[last:]]
        cut = ends[:, None] - np.arange(1, last + 1)
        cut = cut[(cut >= starts[:, None]) & (cut < n)]
        part[cut] = 0
        total[:n] += part
    summed = np.concatenate([[0.0], np.cumsum(total, dtype=np.float64)])
    scores = summed[np.minimum(np.arange(len(symbols)) + STARTS, len(symbols))] - summed[:-1]
    tail = ends[:, None] - np.arange(1, STARTS)
    tail_end = np.broadcast_to(ends[:, None], tail.shape)[tail >= starts[:, None]]
    tail = tail[tail >= starts[:, None]]
    scores[tail] = summed[tail_end] - summed[tail]
    return scores


def text_features(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    """Per text: its highest unit score (EMPTY without units), the logarithms of the number
    of toxic units and of that number per symbol. Texts longer than a block are scored in
    overlapping parts."""
    best = np.full(len(offsets) - 1, EMPTY)
    count = np.zeros(len(offsets) - 1)
    reach = STARTS + SPAN
    for low in range(0, len(data), BLOCK):
        high = min(len(data), low + BLOCK)
        far = min(len(data), high + reach)
        first = int(np.searchsorted(offsets, low, side="right")) - 1
        last = int(np.searchsorted(offsets, far, side="left"))
        bounds = np.clip(offsets[first : last + 1], low, far) - low
        scores = unit_scores(SYMBOL[data[low:far]], bounds, weight)[: high - low] + bias
        starts = bounds[:-1][bounds[:-1] < high - low]
        filled = np.flatnonzero(np.diff(np.append(starts, high - low)) > 0)
        np.maximum.at(best, first + filled, np.maximum.reduceat(scores, starts[filled]))
        count[first + filled] += np.add.reduceat(scores > 0, starts[filled], dtype=np.int64)
    size = np.diff(offsets)
    return np.stack([best, np.log1p(count), np.log1p(1000 * count / np.maximum(size, 200))], axis=1)


def gram_codes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of that length at every place, told apart from those of other lengths, and
    whether all of their symbols but one at most are letters."""
    n = max(len(symbols) - length + 1, 0)
    code = np.full(n, length, np.int64)
    letters = np.zeros(n, np.int64)
    for k in range(length if n else 0):
        code = code * SYMBOLS + symbols[k : k + n]
        letters += symbols[k : k + n] > 0
    return code, letters >= length - 1


def seeds(texts: list[np.ndarray], toxic: np.ndarray) -> list[int]:
    """Grams that tell toxic texts from clean ones, chosen so that each next one covers
    toxic texts that no earlier one did."""

    def own(symbols: np.ndarray) -> np.ndarray:
        return np.unique(np.concatenate([g[ok] for g, ok in map(lambda k: gram_codes(symbols, k), GRAMS)]))

    of_kind = {kind: [t for t, y in zip(texts, toxic, strict=True) if y == kind] for kind in (True, False)}
    in_toxic, n = np.zeros(0, np.int64), np.zeros(0, np.int32)
    for low in range(0, len(of_kind[True]), 50):
        grams, times = np.unique(np.concatenate([own(t) for t in of_kind[True][low : low + 50]]), return_counts=True)
        place = np.searchsorted(in_toxic, grams)
        known = place < len(in_toxic)
        known[known] = in_toxic[place[known]] == grams[known]
        n[place[known]] += times[known].astype(np.int32)
        n = np.insert(n, place[~known], times[~known])
        in_toxic = np.insert(in_toxic, place[~known], grams[~known])
    clean_n = np.zeros(len(in_toxic), np.int64)
    for t in of_kind[False] if len(in_toxic) else []:
        grams = own(t)
        found = np.minimum(np.searchsorted(in_toxic, grams), len(in_toxic) - 1)
        clean_n[found[in_toxic[found] == grams]] += 1
    rate = np.log((n + 0.5) / (toxic.sum() + 1)) - np.log((clean_n + 0.5) / ((~toxic).sum() + 1))
    good = np.flatnonzero((rate > 1.5) & (n >= 2))
    good = good[np.argsort(-(rate * np.sqrt(n))[good], kind="stable")]
    grams, cost = in_toxic[good], clean_n[good]
    order = np.argsort(grams)
    ordered = grams[order]
    held = []  # of each toxic text, which of the grams
    for own_grams in map(own, of_kind[True]):
        place = np.searchsorted(ordered, own_grams)
        hit = (place < len(grams)) & (ordered[np.minimum(place, len(grams) - 1)] == own_grams) if len(grams) else []
        held.append(np.sort(order[place[hit]]).astype(np.int32) if len(grams) else np.zeros(0, np.int32))
    # a toxic text counts until four grams tell it: a stem is covered by several
    missing = np.full(len(held), 4)
    price = 2.0 * toxic.sum() / (~toxic).sum()  # a clean text costs what two toxic ones of equal share gain
    gain = n[good] - price * cost
    chosen: list[int] = []
    while len(chosen) < len(grams):
        best = int(gain.argmax())
        if gain[best] < 2:
            break
        chosen.append(best)
        gain[best] = -np.inf
        for row in np.flatnonzero(missing > 0):
            at = np.searchsorted(held[row], best)
            if at < len(held[row]) and held[row][at] == best:
                missing[row] -= 1
                if not missing[row]:
                    gain[held[row]] -= 1
    return [int(grams[k]) for k in chosen]


def gapped(unit: np.ndarray, often: float, random: np.random.Generator) -> np.ndarray:
    """The unit with separators put between some, or all, of its symbols."""
    out = []
    for symbol in unit:
        out.append(symbol)
        if symbol and random.random() < often:
            out.append(0)
    return np.array((out + [0] * (STARTS + SPAN))[: STARTS + SPAN], np.uint8)


def machine(features: np.ndarray, y: np.ndarray, loss_weight: np.ndarray, ridge: float | None = None) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the bias."""
    width = features.shape[1] + 1
    w = np.zeros(width)
    penalty = np.full(width, RIDGE if ridge is None else ridge)
    penalty[-1] = 1e-8
    loss_weight = loss_weight / loss_weight.sum()
    for _ in range(30):
        gradient, hessian = penalty * w, np.diag(penalty)
        for low in range(0, len(features), ROWS):
            part = slice(low, low + ROWS)
            x = np.hstack([features[part], np.ones((len(features[part]), 1))]).astype(np.float64)
            margin = 1 - y[part] * (x @ w)
            active = margin > 0
            xa, ca = x[active], loss_weight[part][active]
            gradient -= xa.T @ (ca * y[part][active] * margin[active])
            hessian += (xa * ca[:, None]).T @ xa
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(features: np.ndarray, truth: np.ndarray, prior: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression by damped Newton steps; the last weight is the constant."""
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.hstack([(features - mean) / spread, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (prior * (p - truth)) + ridge * w
        hessian = (x * (prior * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    w[:-1] /= spread
    w[-1] -= w[:-1] @ mean
    return w


def kernel_machine(units: np.ndarray, y: np.ndarray, landmarks: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of all subsequences and the bias, from units [n, STARTS + SPAN]."""
    row = units.shape[1]
    marks, weights = unit_codes(landmarks.ravel().astype(np.int32), np.arange(len(landmarks)) * row)
    used = np.unique(marks)
    column = np.full(SYMBOLS**3, len(used), np.int32)
    column[used] = np.arange(len(used))
    phi = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for k in range(marks.shape[1]):
        np.add.at(phi, (column[marks[:, k]], np.arange(len(landmarks))), weights[k])
    values, vectors = np.linalg.eigh((phi.T @ phi).astype(np.float64))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    features = np.empty((len(units), half.shape[1]), np.float32)
    for low in range(0, len(units), ROWS):
        part = units[low : low + ROWS].astype(np.int32)
        codes, _ = unit_codes(part.ravel(), np.arange(len(part)) * row)
        near = np.zeros((len(part), len(landmarks)), np.float32)
        for k in range(codes.shape[1]):
            near += weights[k] * phi[column[codes[:, k]]]
        features[low : low + ROWS] = near @ half
    positive = y > 0
    loss_weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    w = machine(features, y, loss_weight)
    weight = np.zeros(SYMBOLS**3)
    weight[used] = phi[:-1] @ (half @ w[:-1])
    return weight.astype(np.float32), float(w[-1])


def train(texts: list[bytes], toxic: np.ndarray, clean_share: float) -> Model | None:
    """``clean_share``: of all labelled texts, for the threshold's balance of errors."""
    if not toxic.any() or toxic.all():
        return None
    random = np.random.default_rng(7)
    pad = np.zeros(STARTS + SPAN, np.int32)
    narrow = SYMBOL.astype(np.uint8)
    symbols = [narrow[np.frombuffer(t, np.uint8)] for t in texts]
    half = np.zeros(len(texts), bool)
    for kind in (True, False):  # every other text of each class; a single one does both
        own = np.flatnonzero(toxic == kind)
        half[own[::2]] = True
    fit_rows = np.flatnonzero(half)

    def padded(i: int) -> np.ndarray:
        return np.concatenate([symbols[i].astype(np.int32), pad])

    grams = np.array(seeds([symbols[i] for i in fit_rows], toxic[fit_rows]), np.int64)
    width = STARTS + SPAN

    positives, plain = [], []
    told: dict[int, np.ndarray] = {}  # by gram, a unit that holds it
    for i in fit_rows[toxic[fit_rows]]:
        s = padded(i)
        codes = [gram_codes(s, k)[0] for k in GRAMS]
        hits = [np.flatnonzero(np.isin(c, grams)) for c in codes]
        for code, own in zip(codes, hits, strict=True):
            for at in own[own + width <= len(s)]:
                if int(code[at]) not in told:
                    told[int(code[at])] = s[at : at + width].astype(np.uint8)
        for at in np.unique(np.concatenate(hits))[:UNITS_OF_TEXT]:
            if at + width <= len(s):
                plain.append(s[at : at + width].astype(np.uint8))
                positives += [plain[-1], *(gapped(plain[-1], p, random) for p in GAPS)]
    clean_rows = fit_rows[~toxic[fit_rows]]
    share = max(1, NEGATIVE_UNITS // max(len(clean_rows), 1))
    negatives = []
    for i in clean_rows:
        s = padded(i)
        room = len(s) - width
        for at in random.integers(0, room, share) if room > 0 else []:
            negatives.append(s[at : at + width].astype(np.uint8))
    if not positives or not negatives:
        return None
    for _ in range(ROUNDS):
        units = np.stack(positives + negatives)
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        picks = [plain[k] for k in random.permutation(len(plain))[:120]]
        picks += [negatives[k] for k in random.permutation(len(negatives))[:40]] + negatives[-40:]
        picks += told.values()
        weight, bias = kernel_machine(units, y, np.unique(np.stack(picks), axis=0))
        for i in clean_rows:  # what it took for toxic teaches it next time
            s = padded(i)
            scores = unit_scores(s[: len(symbols[i])], np.array([0, len(symbols[i])]), weight)
            if len(scores):
                for at in np.argsort(-scores)[:2]:
                    if scores[at] + bias > -1 and at + width <= len(s):
                        negatives.append(s[at : at + width].astype(np.uint8))

    rest = ~half if toxic[~half].any() and not toxic[~half].all() else half
    data = np.frombuffer(b"".join(t for t, r in zip(texts, rest, strict=True) if r), np.uint8)
    sizes = [len(t) for t, r in zip(texts, rest, strict=True) if r]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    truth = toxic[rest]
    prior = np.where(truth, (1 - clean_share) / truth.sum(), clean_share / (~truth).sum())
    features = text_features(data, offsets, weight, bias)
    blend = logistic(features, truth, prior)
    best = features @ blend[:-1] + blend[-1]
    cuts = np.unique(best)
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    missed = np.searchsorted(np.sort(best[truth]), cuts) / truth.sum()
    taken = 1 - np.searchsorted(np.sort(best[~truth]), cuts) / (~truth).sum()
    errors = missed * (1 - clean_share) + taken * clean_share
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    threshold = float(cuts[least[len(least) // 2]])
    spread = np.abs(best - threshold)
    return Model(weight, bias, blend, threshold, float(4 / max(np.median(spread), 1e-6)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int, max_bytes: int) -> tuple[list[bytes], np.ndarray, float]:
    """Labelled texts in the order of a hash of their id, and the share of clean labels."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    usable = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).where(
        F.octet_length("text").between(1, max_bytes)
    )
    # labels without a text to learn from take up no place
    known = shared.stage(known.join(usable.select("doc_id"), "doc_id", "left_semi"), "toxic-labels")
    chosen = [known.where(F.col("toxic") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    few = chosen[0].unionByName(chosen[1])  # at most 2 * per_class rows, whatever the input
    texts = (
        usable.join(F.broadcast(few), "doc_id")
        .dropDuplicates(["doc_id"])
        .toArrow()
        .sort_by("doc_id")
    )
    shared.release(known)
    toxic = np.array(texts.column("toxic").to_pylist(), bool)
    return texts.column("text").to_pylist(), toxic, n.get(0, 0) / max(sum(n.values()), 1)


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES
) -> Model | None:
    return train(*sample(docs, labels, per_class, max_bytes))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns and ``toxicity``, from 0 to 1; 0.5 and more is toxic."""
    docs = docs.drop("toxicity")
    parts = (model.weight, model.bias, model.blend, model.threshold, model.scale) if model else None
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    names = docs.columns

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value) if sent.value else None
        for batch in batches:
            data, offsets = shared.byte_view(batch.column(len(names)))
            margins = own.margins(data, offsets) if own else np.full(len(offsets) - 1, -np.inf)
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            scores = np.where(np.isfinite(margins), scores, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*names, "toxicity"]
            )

    rated = F.coalesce(F.col("text").cast("string"), F.lit("")).alias(shared.fresh("rated", docs))
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])
    return docs.select("*", rated).mapInArrow(rate, schema)
