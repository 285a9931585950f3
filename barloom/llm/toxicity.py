"""Toxicity of texts by a small convolutional network over hashed word embeddings, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, hashes_of, save, word_codes

#: Stripped from both ends of a word before it is hashed.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…–—¿¡"
WIDTHS = (1, 2, 3)
#: Letters of the beginnings of a word that have rows of their own.
PIECES = (4, 5, 6, 7)
#: Toxic texts are rare: a share of the clean ones flagged costs this much more than one of the toxic missed.
FALSE_ALARM = 4
#: Logits are counted in steps of this size to find thresholds.
LOGIT_STEP = 1e-3


@dataclass
class Model:
    """Two hashed embedding tables, filters by width and offset, a dense layer and its thresholds."""

    tables: np.ndarray  # 2 x buckets x size; row 0 is padding and stays zero
    filters: list  # by width: width x size x filters
    biases: list
    dense: np.ndarray
    offset: float
    vocabulary: np.ndarray  # sorted hashes of the words known from training
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)

    def copy(self):
        own = [self.tables.copy(), [f.copy() for f in self.filters], [b.copy() for b in self.biases], self.dense.copy()]
        return Model(*own, self.offset, self.vocabulary, self.scale, self.shift, dict(self.thresholds))

    @property
    def buckets(self):
        return self.tables.shape[1]

    def word_rows(self, words):
        """The rows in the two tables of each form of each word (2 x forms x words); unknown forms have that of padding."""
        h = forms(words)
        rows = np.zeros((2, *h.shape), np.int64)
        if len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
            most, known = np.uint64(self.buckets - 1), self.vocabulary[at] == h
            low = h & np.uint64(0xFFFFFFFF)
            rows[0] = np.where(known, 1 + (low % most).astype(np.int64), 0)
            rows[1] = np.where(known, 1 + ((h >> np.uint64(32)) % most).astype(np.int64), 0)
        return rows

    def vectors(self, rows):
        """The embeddings of words, each the sum over its forms."""
        return self.tables[0][rows[0]].sum(axis=0) + self.tables[1][rows[1]].sum(axis=0)

    def pooled(self, rows, codes, starts):
        """(largest response of each filter in each text, where it was) over padded texts.

        `rows` has the table rows of the distinct words with padding as the last; `codes` the
        words of all texts, each followed by enough padding for the widest filter.
        """
        vectors = self.vectors(rows)
        ends = starts[1:]
        values, places = [], []
        for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
            out = (vectors @ filters[0])[codes]
            for k in range(1, width):
                out[:-k] += (vectors @ filters[k])[codes[k:]]
                # Windows that run into the next text begin in the padding and count for nothing.
                out[ends - k] = -np.inf
            best = np.maximum.reduceat(out, starts[:-1], axis=0)
            values.append(np.maximum(best + bias, 0))
            places.append((out, best))
        return np.concatenate(values, axis=1), places

    def logits(self, texts):
        rows, codes, starts = self.read(texts)
        values, _ = self.pooled(rows, codes, starts)
        return values @ self.dense + self.offset

    def read(self, texts):
        """Table rows of the distinct words, and the codes and starts of the texts by `near_known`."""
        codes, starts, words = padded(texts)
        rows = with_padding(self.word_rows(words))
        return rows, *near_known(codes, starts, rows.any(axis=(0, 1)))

    def scores(self, texts):
        z = self.scale * self.logits(texts) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def forms(words):
    """Hashes of the words and of their beginnings, which inflected and compounded forms share.

    A row for the words, and one for each length of PIECES; a word no longer than that has its own
    hash there, spelled so that it is not the word's.
    """
    bare = [w.strip(MARKS) for w in words]
    return np.stack([hashes_of(bare), *[hashes_of([f"{w[:n]}*{n}" for w in bare]) for n in PIECES]])


def with_padding(rows):
    """The rows of words with those of padding as the last."""
    return np.concatenate([rows, np.zeros((*rows.shape[:2], 1), np.int64)], axis=2)


def padded(texts):
    """Words of all texts with padding (code = number of distinct words) behind each."""
    codes, starts, words = word_codes(texts)
    pad = max(WIDTHS)
    lengths = np.diff(starts)
    begin = starts[:-1] + pad * np.arange(len(lengths))
    out = np.full(len(codes) + pad * len(lengths), len(words), dtype=np.int64)
    out[np.arange(len(codes)) + np.repeat(pad * np.arange(len(lengths)), lengths)] = codes
    return out, np.append(begin, len(out)), words


def near_known(codes, starts, known):
    """The codes of known words and of what any window that holds one covers, and the padding behind each text.

    The windows that go have unknown words only. Each gives what one over padding gives, which every
    text has at its end, so no largest response changes.
    """
    hits = known[codes]
    keep = hits.copy()
    for k in range(1, max(WIDTHS)):
        keep[k:] |= hits[:-k]
        keep[:-k] |= hits[k:]
    for k in range(1, max(WIDTHS) + 1):
        keep[starts[1:] - k] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[starts]


def form_counts(texts, toxic):
    """Hashes of all forms of words, and how many toxic texts and texts at all hold each."""
    codes, starts, words = word_codes(texts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
    seen_text, seen = np.divmod(np.unique(text_of * (len(words) + 1) + codes), len(words) + 1)
    found = []
    for h in forms(words):
        plain, inverse = np.unique(h, return_inverse=True)
        # A form counts once for each text.
        text, form = np.divmod(np.unique(seen_text * (len(plain) + 1) + inverse[seen]), len(plain) + 1)
        found.append((plain, np.bincount(form[toxic[text]], minlength=len(plain)), np.bincount(form, minlength=len(plain))))
    return [np.concatenate(x) for x in zip(*found)]


def untrained(rng, buckets=1 << 16, size=8, filters=24) -> Model:
    model = Model(
        rng.normal(0, 0.1, (2, buckets, size)).astype(np.float32),
        [rng.normal(0, 0.3, (w, size, filters)).astype(np.float32) for w in WIDTHS],
        [np.zeros(filters, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, filters * len(WIDTHS)).astype(np.float32),
        0.0,
        np.zeros(0, np.uint64),
    )
    model.tables[:, 0] = 0
    return model


def untaught(model) -> Model:
    """A constant score under the threshold."""
    model.dense[:] = 0
    model.offset = -3.0
    return model


class Trainer:
    """Sparse Adagrad: of the embeddings only rows behind a filter's largest response move."""

    def __init__(self, model, share, step=0.05):
        self.model, self.share, self.step = model, share, step
        self.squares = [np.full_like(p, 1e-4) for p in (model.tables, *model.filters, *model.biases, model.dense)]
        self.offset_square = 1e-4

    def resume(self, other):
        """Go on with a copy of another trainer's sums of squares."""
        self.squares, self.offset_square = [s.copy() for s in other.squares], other.offset_square
        return self

    def _move(self, param, square, gradient):
        square += gradient**2
        param -= self.step * gradient / np.sqrt(square)

    def learn(self, rows, flat, first, labels):
        """One step over some texts, given as table rows of words and as codes and starts."""
        model, squares = self.model, self.squares
        size, filters = model.tables.shape[2], model.filters[0].shape[2]
        weight = np.where(labels == 1, 0.5 / self.share, 0.5 / (1 - self.share)).astype(np.float32)
        used, local = np.unique(flat, return_inverse=True)
        values, places = model.pooled(rows[:, :, used], local, first)
        p = 1 / (1 + np.exp(-np.clip(values @ model.dense + model.offset, -30, 30)))
        error = (p - labels) * weight / len(labels)
        back = error[:, None] * model.dense * (values > 0)
        touched, changes = [], []
        grads = []
        for k, (width, f) in enumerate(zip(WIDTHS, model.filters)):
            out, best = places[k]
            g = back[:, k * filters : (k + 1) * filters]
            # The first place of each text and filter with the largest response.
            text_of = np.repeat(np.arange(len(labels)), np.diff(first))
            hit, which = np.nonzero(out == best[text_of])
            keys = text_of[hit] * filters + which
            keys, where = np.unique(keys, return_index=True)
            spot = hit[where]
            g = g.reshape(-1)[keys]
            which = keys % filters
            df = np.zeros_like(f)
            for o in range(width):
                r = rows[:, :, flat[np.minimum(spot + o, len(flat) - 1)]]
                np.add.at(df[o].T, which, g[:, None] * model.vectors(r))
                touched.append(r)
                changes.append(g[:, None] * f[o][:, which].T)
            db = np.zeros(filters, np.float32)
            np.add.at(db, which, g)
            grads.append((df, db))
        dense_gradient = values.T @ error
        r, change = np.concatenate(touched, axis=2), np.concatenate(changes)
        change = np.tile(change, (r.shape[1], 1))
        for t in (0, 1):
            own, inverse = np.unique(r[t].ravel(), return_inverse=True)
            g = np.zeros((len(own), size), np.float32)
            np.add.at(g, inverse, change)
            g[own == 0] = 0
            sq = squares[0][t][own] + g**2
            squares[0][t][own] = sq
            model.tables[t][own] -= self.step * g / np.sqrt(sq)
        for k, (df, db) in enumerate(grads):
            self._move(model.filters[k], squares[1 + k], df)
            self._move(model.biases[k], squares[1 + len(WIDTHS) + k], db)
        self._move(model.dense, squares[-1], dense_gradient)
        self.offset_square += error.sum() ** 2
        model.offset -= self.step * error.sum() / np.sqrt(self.offset_square)

    def epochs(self, texts, labels, some, rng, epochs, batch):
        """Learn from `some` of the texts, in a new order each time."""
        rows, codes, starts = self.model.read(pa.array(texts, pa.string()))
        for _ in range(epochs):
            rng.shuffle(some)
            for at in range(0, len(some), batch):
                now = some[at : at + batch]
                parts = [codes[starts[i] : starts[i + 1]] for i in now]
                first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                self.learn(rows, np.concatenate(parts), first, labels[now])


def worth_knowing(bad, every, share):
    """Known are forms that three toxic texts have, if their share in these is three times that in clean ones.

    The others say nothing of toxicity, and would be learned by heart.
    """
    return (bad >= 3) & (bad * (1 - share) > 3 * (every - bad) * share)


def train(texts, labels, langs, *, epochs=12, step=0.05, batch=32, held=5, seed=7, **shape) -> Model:
    """Fit a model to labelled texts in memory; every `held`-th is left out of fitting, for calibration.

    With one class only, or no text, the model gives a constant score under the threshold.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.float32)
    model = untrained(rng, **shape)
    if len(labels) == 0 or labels.min() == labels.max():
        return untaught(model)
    order = rng.permutation(len(labels))
    test, fit = order[::held], np.setdiff1d(order, order[::held])
    found, bad, every = form_counts(pa.array(texts, pa.string()), labels == 1)
    model.vocabulary = np.unique(found[worth_knowing(bad, every, labels.mean())])
    Trainer(model, labels.mean(), step).epochs(texts, labels, fit, rng, epochs, batch)
    calibrate(model, [texts[i] for i in test], labels[test], [langs[i] for i in test])
    return model


def _threshold(z, bad, good):
    """The middle of the widest gap between logits that lose least; a false alarm counts FALSE_ALARM times.

    `z` ascends; `bad` and `good` count the toxic and the clean texts of each.
    """
    above = bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    below = np.concatenate([[0], np.cumsum(good)])
    right = above / max(1, bad.sum()) + FALSE_ALARM * below / max(1, good.sum())
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    best = np.flatnonzero(right >= right.max() - 1e-9)
    gap = edges[best + 1] - edges[best]
    k = best[np.argmax(gap)]
    return float(edges[k] + edges[k + 1]) / 2


def _merged(z, bad, good):
    plain, inverse = np.unique(z, return_inverse=True)
    return plain, np.bincount(inverse, bad), np.bincount(inverse, good)


def _median(z, count):
    order = np.argsort(z)
    ends = np.cumsum(count[order])
    return float(z[order][np.searchsorted(ends, ends[-1] / 2)])


def calibrate(model, texts, labels, langs, at=0.7, least=40):
    """`calibrate_counts` by texts in memory."""
    if len(texts):
        z = model.logits(pa.array(texts, pa.string()))
        calibrate_counts(model, z, labels == 1, labels != 1, langs, at, least)


def calibrate_counts(model, z, bad, good, langs, at=0.7, least=40):
    """Put the decision at score `at`, and find each language's own threshold.

    `bad` and `good` count the toxic and the clean texts of a logit `z` and a language. A language
    with fewer than `least` texts or only one class takes the common threshold.
    """
    z, bad, good = (np.asarray(x, np.float64) for x in (z, bad, good))
    if not bad.sum() or not good.sum():
        return
    middle = _median(z, bad + good)
    spread = _median(np.abs(z - middle), bad + good)
    cut = _threshold(*_merged(z, bad, good))
    # Where most texts have the same logit, as those without a known word, their spread says nothing.
    model.scale = float(np.clip(1.0, 1.0 / (spread * 10), 4.0 / spread)) if spread > LOGIT_STEP else 1.0
    model.shift = float(np.log(at / (1 - at)) - model.scale * cut)
    model.thresholds = {"": at}
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if (bad + good)[own].sum() >= least and bad[own].sum() and good[own].sum():
            t = model.scale * _threshold(*_merged(z[own], bad[own], good[own])) + model.shift
            model.thresholds[lang] = float(1 / (1 + np.exp(-t)))


def labelled_texts(docs: DataFrame, labels: DataFrame, held: int) -> DataFrame:
    """doc_id, text, lang and toxic of every labelled document; every `held`-th is `kept_out` of fitting.

    Null texts count as empty. Of rows that repeat an id the least text stands for it.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").join(known, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "lang", (F.col("toxic") == 1).alias("toxic"))).alias("row"))
    return rows.select("doc_id", "row.*", (F.pmod(F.xxhash64("doc_id"), F.lit(held)) == 0).alias("kept_out"))


def known_forms(texts: DataFrame, share: float) -> np.ndarray:
    """Sorted hashes of the forms worth knowing, counted over all texts; only these come to the driver."""
    kinds = pa.schema([("form", pa.int64()), ("bad", pa.int64()), ("every", pa.int64())])

    def run(batches):
        for batch in bounded(batches, most=2_000_000):
            toxic = column(batch, "toxic").to_numpy(zero_copy_only=False)
            found, bad, every = form_counts(column(batch, "text"), toxic)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.uint64).view(np.int64)) for x in (found, bad, every)], schema=kinds)

    counts = texts.select("text", "toxic").mapInArrow(run, "form long, bad long, every long")
    counts = counts.groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("every").alias("every"))
    found = counts.where(worth_knowing(F.col("bad"), F.col("every"), F.lit(share))).select("form").toArrow()
    return np.sort(found["form"].to_numpy().view(np.uint64))


def _flat(model):
    return np.concatenate(
        [x.ravel() for x in (model.tables, *model.filters, *model.biases, model.dense)] + [[np.float32(model.offset)]]
    )


def _set_flat(model, flat):
    at = 0
    for x in (model.tables, *model.filters, *model.biases, model.dense):
        x[...] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    model.offset = float(flat[at])


def pass_over(texts: DataFrame, trainer: Trainer, batch: int = 32) -> None:
    """Every text once, in as many streams as the table has partitions; each goes on from the trainer's state.

    A parameter then takes the mean of the streams that moved it, weighted by their texts. Streams
    send only what they moved, and Spark adds it up.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trainer)
    kinds = pa.schema([("place", pa.int64()), ("moved", pa.float64()), ("texts", pa.int64())])

    def run(batches):
        own = shared.value
        own = Trainer(own.model.copy(), own.share, own.step).resume(own)
        before, seen = _flat(own.model), 0
        for some in bounded(batches, most=2_000_000):
            rows, codes, starts = own.model.read(column(some, "text"))
            labels = column(some, "toxic").to_numpy(zero_copy_only=False).astype(np.float32)
            for at in range(0, len(labels), batch):
                part = starts[at : at + batch + 1]
                own.learn(rows, codes[part[0] : part[-1]], part - part[0], labels[at : at + batch])
            seen += len(labels)
        moved = _flat(own.model).astype(np.float64) - before
        at = np.flatnonzero(moved)
        for k in range(0, len(at), 100_000):
            some = at[k : k + 100_000]
            columns = [pa.array(some), pa.array(moved[some] * seen), pa.array(np.full(len(some), seen, np.int64))]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    found = texts.select("text", "toxic").mapInArrow(run, "place long, moved double, texts long")
    found = found.groupBy("place").agg((F.sum("moved") / F.sum("texts")).alias("moved")).toArrow()
    flat = _flat(trainer.model)
    flat[found["place"].to_numpy()] += found["moved"].to_numpy().astype(np.float32)
    _set_flat(trainer.model, flat)


def logit_counts(texts: DataFrame, model: Model) -> DataFrame:
    """How many toxic and clean texts each language has in each step of logits."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kinds = pa.schema([("lang", pa.string()), ("toxic", pa.bool_()), ("step", pa.int64())])

    def run(batches):
        for batch in bounded(batches, most=2_000_000):
            steps = np.rint(shared.value.logits(column(batch, "text")).astype(np.float64) / LOGIT_STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, "lang"), column(batch, "toxic"), pa.array(steps)], schema=kinds)

    steps = texts.select("text", "lang", "toxic").mapInArrow(run, "lang string, toxic boolean, step long")
    return steps.groupBy("lang", "step").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_bytes: int = 200_000, *,
    epochs=12, step=0.05, batch=32, held=5, seed=7, **shape
) -> Model:
    """A model from all labelled documents.

    Known forms are counted over all of them, every document that is not held out is learned from,
    and the thresholds come from all that are. Only the state from which the pass over the
    documents starts is learned on the driver, in some epochs over at most `per_class` documents of
    each class (by a hash of the id) of up to `max_bytes` bytes, which bounds what it holds.
    """
    texts = save(labelled_texts(docs, labels, held), work_path(docs.sparkSession, "labelled"))
    n, bad = texts.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    rng = np.random.default_rng(seed)
    model = untrained(rng, **shape)
    if bad in (0, n):
        return untaught(model)
    model.vocabulary = known_forms(texts, bad / n)
    trainer = Trainer(model, bad / n, step)
    fit = texts.where(~F.col("kept_out"))
    small = fit.where(F.octet_length("text") <= max_bytes)
    first = [small.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for t in (True, False)]
    first = sorted(first[0].unionByName(first[1]).select("doc_id", "text", "toxic").collect())
    if first:
        own = np.array([float(r.toxic) for r in first], np.float32)
        # Classes weigh alike in the first documents as in all of them.
        trainer.share = own.mean() if 0 < own.mean() < 1 else bad / n
        trainer.epochs([r.text for r in first], own, np.arange(len(first)), rng, epochs, batch)
        trainer.share = bad / n
    pass_over(fit, trainer, batch)
    counts = logit_counts(texts.where("kept_out"), model).orderBy("lang", "step").collect()
    calibrate_counts(
        model, [r.step * LOGIT_STEP for r in counts], [r.bad for r in counts], [r.good for r in counts], [r.lang for r in counts]
    )
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and toxic (score against the threshold of the document's language).

    Scores use whole texts only. Null and empty texts get the score of no words at all; repeated
    rows are scored each; extra columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("toxic", pa.bool_())])

    def run(batches):
        model = shared.value
        for batch in bounded(batches, most=2_000_000):
            scores = model.scores(column(batch, "text")).astype(np.float64)
            limit = model.thresholds.get("", 0.7)
            limits = np.array([model.thresholds.get(x or "", limit) for x in column(batch, "lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(scores), pa.array(scores >= limits)], schema=kinds
            )

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, score double, toxic boolean")
