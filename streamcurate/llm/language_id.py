"""Language ID by interpolated Kneser-Ney character models.

For each language, counts of character n-grams give an interpolated Kneser-Ney model.  Its tables
are sorted arrays of 64-bit n-gram hashes, shared by all languages, with one row of log
probabilities (a column per language); a missing n-gram costs the context's back-off weight and the
shorter n-gram.  A text goes to the language of lowest cross-entropy per character.  Rejection is
calibrated on texts kept from training: a text is rejected where its cross-entropy lies far above
what texts of its language have, by a quantile and a margin, and is also as high as texts of other
languages have in that language, but for a small share of these.  Short, noisy or mixed texts of
known languages stay below that.

The models are fitted on a bounded sample: of each language, training texts in the order of a hash
of doc_id and text (rows equal in both count once), as long as they sum to at most `sample_chars` characters and are at most
`sample_texts`.  Of a training text longer than a tenth of `sample_chars` the start of that length is
used, so that no text shuts out the others.  Predictions read whole texts, long ones in segments.

Defined cases: a null text, or one without letters, is `und` with score 0 and rejected; null
languages don't train; without any training text all is `und`; ties go to the language first by
name; repeated rows are judged each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunked, materialize, scrap, shipped, table

ORDER = 5
SAMPLE_CHARS = 300_000
SAMPLE_TEXTS = 3000
#: One training text gives at most this part of the sample.
SAMPLE_SHARE = 10
#: Characters that are scored at once.
SEGMENT = 1 << 18
#: A hashed quarter of the documents is kept from training.
FOLDS, HELD_OUT = 4, 2
QUANTILE, MARGIN, FOREIGN = 0.99, 1.35, 0.05
#: Tables of at most so many languages are broadcast.
MOST_LANGUAGES = 10_000
UNKNOWN = "und"
LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global LETTERS
    if LETTERS is None:
        LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])
    return LETTERS


def normal(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters than letters as one space, spaces around."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.uint32)
    points = np.concatenate(([32], np.where(is_letter, points, 32), [32])).astype(np.uint32)
    space = points == 32
    return points[~(space & np.concatenate(([False], space[:-1])))]


#: Where a text may be cut: `normal` has a space there in any case.
BETWEEN = re.compile(r"[^\w]")


def segments(text: str | None, order: int, limit: int = SEGMENT):
    """The points of `normal` in parts that overlap by all but one of an n-gram, so that each n-gram is in just one.

    A text shorter than an n-gram gets spaces in front.  Without a place to cut within another
    `limit` characters a word is cut, as if there were a space.
    """
    held, at, given = np.zeros(0, np.uint32), 0, False
    while text and at < len(text):
        cut = BETWEEN.search(text, at + limit, at + 2 * limit) if len(text) - at > limit else None
        stop = cut.start() if cut else min(len(text), at + 2 * limit)
        part = normal(text[at:stop])
        at = stop
        held = np.concatenate((held, part[1:] if len(held) and held[-1] == 32 else part))
        if at < len(text) and len(held) >= order:
            yield held
            held, given = held[len(held) - order + 1 :], True
    if len(held) >= order:
        yield held
    elif len(held) and not given:
        yield np.concatenate((np.full(order - len(held), 32, np.uint32), held))


def gram_keys(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive code points, the last one's place included."""
    value = points.astype(np.uint64) + np.uint64(1)
    key = np.zeros(len(points) - n + 1, np.uint64)
    for i in range(n):
        key = (key ^ value[i : len(points) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key ^ np.uint64(n)


class Models:
    """Sorted n-gram tables of all languages together."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.languages, self.order = sorted(texts), order
        count = len(self.languages)
        points = [[p for p in map(normal, texts[lang]) if len(p) >= order] for lang in self.languages]
        joined = [np.concatenate([np.concatenate((p, np.full(order, 1, np.uint32))) for p in ps]) if ps else np.zeros(0, np.uint32) for ps in points]
        self.grams, self.logp, self.contexts, self.backoff = {}, {}, {}, {}
        alphabet = len(np.unique(np.concatenate(joined))) + 1 if count else 1
        # counts of the highest order; lower orders count distinct continuations to the left
        rows = {n: [] for n in range(1, order + 1)}
        for ps in joined:
            top = {}
            for n in range(order, 0, -1):
                if len(ps) < n:
                    rows[n].append((np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                    continue
                key = gram_keys(ps, n)
                first, which, many = np.unique(key, return_index=True, return_counts=True)[0:3]
                if n == order:
                    value = many
                else:
                    # continuation count: how many distinct longer n-grams end in this one
                    longer = top["key"][top["first"]]
                    ends = key[top["first"] + 1]
                    del longer
                    sub, value_of = np.unique(ends, return_counts=True)
                    value = np.zeros(len(first), np.int64)
                    at = np.searchsorted(sub, first)
                    at[at == len(sub)] = 0
                    value = np.where(sub[at] == first, value_of[at], 0) if len(sub) else value
                context = gram_keys(ps, n - 1)[which] if n > 1 else np.zeros(len(first), np.uint64)
                shorter = gram_keys(ps, n - 1)[which + 1] if n > 1 else np.zeros(len(first), np.uint64)
                rows[n].append((first, context, value.astype(np.int64), shorter))
                top = {"key": key, "first": which}
        for n in range(1, order + 1):
            keys = np.unique(np.concatenate([r[0] for r in rows[n]])) if count else np.zeros(0, np.uint64)
            ctx = np.unique(np.concatenate([r[1] for r in rows[n]])) if count else np.zeros(0, np.uint64)
            p, lam = np.zeros((len(keys), count)), np.ones((len(ctx), count))
            shorter_of = np.zeros(len(keys), np.uint64)
            context_of = np.zeros(len(keys), np.uint64)
            for k, (first, context, value, shorter) in enumerate(rows[n]):
                seen = value > 0
                first, context, value, shorter = first[seen], context[seen], value[seen], shorter[seen]
                shorter_of[np.searchsorted(keys, rows[n][k][0])] = rows[n][k][3]
                context_of[np.searchsorted(keys, rows[n][k][0])] = rows[n][k][1]
                if not len(first):
                    continue
                ones, twos = (value == 1).sum(), (value == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                at = np.searchsorted(ctx, context)
                total = np.bincount(at, value, minlength=len(ctx))
                kinds = np.bincount(at, minlength=len(ctx))
                lam[:, k] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                p[np.searchsorted(keys, first), k] = (value - discount) / total[at]
            if n == 1:
                below = np.full((len(keys), count), 1.0 / alphabet)
            else:
                below = np.exp(self.lookup(n - 1, shorter_of))
            p += lam[np.searchsorted(ctx, context_of)] * below if len(keys) else 0
            self.grams[n], self.logp[n] = keys, np.log(p).astype(np.float32)
            self.contexts[n], self.backoff[n] = ctx, np.log(lam).astype(np.float32)
        self.floor = float(np.log(1.0 / alphabet)) if count else 0.0
        self.limit = np.full(count, np.inf)

    def lookup(self, n: int, key: np.ndarray) -> np.ndarray:
        """Rows of log probabilities of known n-grams of length n."""
        return self.logp[n][np.searchsorted(self.grams[n], key)]

    def scores(self, points: np.ndarray) -> np.ndarray:
        """Log probability of every n-gram of full order (a row each, a column per language)."""
        n = self.order
        size = len(points) - n + 1
        out = np.zeros((size, len(self.languages)), np.float32)
        todo = np.arange(size)
        while n:
            # an n-gram of any order ends where the full one does
            grams = gram_keys(points, n)[self.order - n :] if n == self.order else None
            key = grams if grams is not None else self.keys_at(points, todo + self.order - n, n)
            at = np.searchsorted(self.grams[n], key)
            at[at == len(self.grams[n])] = 0
            known = self.grams[n][at] == key
            out[todo[known]] += self.logp[n][at[known]]
            todo = todo[~known]
            if not len(todo):
                break
            if n == 1:
                out[todo] += self.floor + self.backoff[1][0]
            else:
                context = self.keys_at(points, todo + self.order - n, n - 1)
                at = np.searchsorted(self.contexts[n], context)
                at[at == len(self.contexts[n])] = 0
                known = self.contexts[n][at] == context
                out[todo[known]] += self.backoff[n][at[known]]
            n -= 1
        return out

    @staticmethod
    def keys_at(points: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
        value = points.astype(np.uint64) + np.uint64(1)
        key = np.zeros(len(start), np.uint64)
        for i in range(n):
            key = (key ^ value[start + i]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key ^ np.uint64(n)

    def entropies(self, texts: list[str | None], limit: int = SEGMENT) -> np.ndarray:
        """Cross-entropy per character of each text (rows) in each language; nan without letters."""
        total, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        parts = ((row, part) for row, text in enumerate(texts) for part in segments(text, self.order, limit))
        for chunk in chunked(parts, lambda x: len(x[1]), limit) if self.languages else ():
            # n-grams across two texts are left out
            logp = self.scores(np.concatenate([part for _, part in chunk]))
            end = 0
            for row, part in chunk:
                end += len(part)
                total[row] -= logp[end - len(part) : end - self.order + 1].sum(axis=0, dtype=np.float64)
                count[row] += len(part) - self.order + 1
        return np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], np.nan)


def training(docs: DataFrame, sample_chars: int, sample_texts: int = SAMPLE_TEXTS) -> dict[str, list[str]]:
    """The bounded sample: language -> texts."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    able = docs.where((fold != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0) & (F.col("lang") != UNKNOWN))
    able = able.select("lang", "text", F.xxhash64("doc_id", "text").alias("_order"))
    longest = max(1, sample_chars // SAMPLE_SHARE)
    # rows equal in doc_id and text train once, so that the bounds hold whatever repeats
    lean = materialize(able.groupBy("lang", "_order").agg(F.least(F.min(F.length("text")), F.lit(longest)).alias("_n")), "lengths")
    # only texts whose hash is among the smallest of their language are ranked, whatever the corpus holds
    counts = lean.groupBy("lang").agg(F.count("*").alias("_count"))
    share = (F.col("_order") / F.lit(2.0**63) + 1) / 2
    counts = F.broadcast(counts) if counts.count() <= MOST_LANGUAGES else counts
    few = lean.join(counts, "lang").where(share * F.col("_count") <= 2 * sample_texts)
    by_hash = Window.partitionBy("lang").orderBy("_order")
    near = few.withColumn("_rank", F.row_number().over(by_hash)).where(F.col("_rank") <= sample_texts)
    run = F.sum("_n").over(by_hash.rowsBetween(Window.unboundedPreceding, 0))
    chosen = materialize(near.withColumn("_sum", run).where(F.col("_sum") <= sample_chars).select("lang", "_order"), "chosen")
    found = able.select("lang", "_order", F.substring("text", 1, longest).alias("text")).join(F.broadcast(chosen) if chosen.count() <= 100_000 else chosen, ["lang", "_order"], "left_semi")
    found = found.groupBy("lang", "_order").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in sorted(found.select("lang", "text").collect(), key=lambda r: (r["lang"], r["text"])):
        out.setdefault(r["lang"], []).append(r["text"])
    scrap(lean, chosen)
    return out


def fit(docs: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS, sample_texts: int = SAMPLE_TEXTS) -> Models:
    """Models of all languages, with each one's rejection limit from the texts it was fitted on."""
    texts = training(docs, sample_chars, sample_texts)
    # a fifth of each language's texts calibrates and doesn't train, where there are enough
    held = {k: v[::5] if len(v) >= 10 else v for k, v in texts.items()}
    own = {k: [t for i, t in enumerate(v) if i % 5] if len(v) >= 10 else v for k, v in texts.items()}
    models = Models(own, order)
    costs = {lang: e[np.isfinite(e).all(axis=1)] for lang in models.languages for e in [models.entropies(held[lang])]}
    for k, lang in enumerate(models.languages):
        values = costs[lang][:, k]
        others = np.concatenate([np.zeros(0), *(costs[x][:, k] for x in models.languages if x != lang)])
        if len(values):
            models.limit[k] = np.quantile(values, QUANTILE) * MARGIN
            if len(others):
                models.limit[k] = max(models.limit[k], np.quantile(others, FOREIGN))
    return models


def judge(models: Models, texts: list[str | None]):
    """(language, score, rejected) of each text."""
    out = []
    for row in models.entropies(texts):
        if not len(row) or not np.isfinite(row).all():
            out.append((UNKNOWN, 0.0, True))
            continue
        best = int(row.argmin())
        # per-character odds, sharpened to twenty characters' worth
        score = 1.0 / np.exp(-20.0 * (row - row[best])).sum()
        out.append((models.languages[best], float(score), bool(row[best] > models.limit[best])))
    return out


def judged(models: Models, batch: pa.RecordBatch) -> list[tuple]:
    texts = batch.column("text").cast(pa.large_string()).to_pylist()
    return judge(models, texts)


def recognised(docs: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """The rows of `docs` whose language isn't rejected, as they are."""
    sent = shipped(docs.sparkSession, fit(docs, order, sample_chars))

    def run(batches):
        models = sent()
        for batch in batches:
            yield batch.filter(pa.array([not rejected for _, _, rejected in judged(models, batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """The columns of `docs` and held_out, lang_pred, score, rejected (in place of columns with these names)."""
    spark = docs.sparkSession
    docs = docs.drop("held_out", "lang_pred", "score", "rejected")
    sent = shipped(spark, fit(docs, order, sample_chars))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = docs.withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(False)))
    schema = rows.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected")).schema

    def run(batches):
        models = sent()
        for batch in batches:
            found = judged(models, batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([x[i] for x in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_())))],
                [*batch.schema.names, "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(run, schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text", "lang")).select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "lang_pred", "score", "rejected")
