"""Language identification with Kneser-Ney character models.

For each language an interpolated Kneser-Ney model of character 4-grams is trained on the
texts that carry that language.  A text gets the language under which its cross-entropy per
character is lowest.  It is rejected if that lowest cross-entropy lies far above what is usual,
for training texts of that language and about that length, or if it has no letter.  What is usual
is seen by cross-fitting: the training texts are in two folds, and a model of one judges the other.

The models are estimated from all counts, as Spark tables.  They are cut into shards of bounded size, each
a broadcast of its own, which a task reads one after another and of which it holds one at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, save, slices
from alertlake.llm.grams import BITS, ORDER, Model, Tally, letter_codes, text_grams
from alertlake.llm.quality import Tables

#: Rows of the models' tables in a shard: what the driver and a task hold of the models at a time.
SHARD_ROWS = 2_000_000
#: Bytes of text that a task looks at with each shard in turn, where there are several.
CHUNK_BYTES = 8 << 20
UNKNOWN = "und"
#: Where the limits of languages with few training texts are.
REST = "\0rest"
#: A length class, or a language, calibrates if it has so many training texts.
SUPPORT = 20
#: How far above the median the limit is, in distances from the median to the third quartile.
SLACK = 20.0
#: The least such distance, as a share of the median: many copies of a text leave no spread.
LEAST_SPREAD = 0.01
#: The power of the length by which it grows towards shorter texts: 0.5 were characters independent.
WIDEN = 1 / 3


def held_out(id_col: F.Column) -> F.Column:
    """Documents that are never learned from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _lowered(texts: list[str | None]) -> list[str]:
    return [(t or "").lower() for t in texts]


def _folds(lowered: list[str]) -> np.ndarray:
    """0 or 1 for each text, the same for equal ones: no copy of a text is in the model that judges it."""
    return np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) & 1 for t in lowered), np.int64, len(lowered))


def _name(lang: str, fold: str) -> str:
    """The name of a model: of all texts of a language (fold "all") or those of one fold ("0", "1")."""
    return f"{lang}/{fold}"


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts (columns lang, text), and over those of each fold; an n-gram is a signed long.

    ``lang`` is a model's name, see ``_name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for part in slices(batches, "text"):
            lowered = _lowered(part.column(1).to_pylist())
            grams, counts = text_grams(lowered, letter_codes())
            labels = [_name(x, str(f)) for x, f in zip(part.column(0).to_pylist(), _folds(lowered))]
            of, names = pd.factorize(np.array(labels, object))
            of = np.repeat(of, counts)
            for i, name in enumerate(names):
                tallies.setdefault(name, Tally()).add(grams[of == i])
        for name, tally in tallies.items():
            grams, counts = tally.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"])

    folds = save(docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
                 .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    both = F.concat(F.expr("substring(lang, 1, length(lang) - 1)"), F.lit("all"))
    return folds.unionByName(folds.groupBy(both.alias("lang"), "gram").agg(F.sum("n").alias("n")))


#: An n-gram's two middle characters decide on its part: they are in it and in its context of every order above 2.
_MIDDLE = (1 << 2 * BITS) - 1
_PRIME = 1_000_003


def _part(grams: np.ndarray, parts: int) -> np.ndarray:
    """The number of the part that answers for each n-gram of the highest order."""
    middle = grams >> np.uint64(BITS) & np.uint64(_MIDDLE)
    return middle % np.uint64(_PRIME) % np.uint64(parts)


def _rows(tables: Tables) -> DataFrame:
    """The models' tables as one: (lang, level, kind, gram, value, middle).

    Level 0 is the equal share; kind 0 holds shares of n-grams, kind 1 what contexts leave.  ``middle`` is null for the
    levels that every part of a model has."""
    def one(level: int, kind: int, rows: DataFrame, gram: str, value: str) -> DataFrame:
        own = F.col(gram).cast("long")
        middle = F.lit(None).cast("long")
        if level > 2:
            middle = (own if kind else F.shiftrightunsigned(own, BITS)).bitwiseAND(F.lit(_MIDDLE)) % _PRIME
        return rows.select("lang", F.lit(level).alias("level"), F.lit(kind).alias("kind"), own.alias("gram"),
                           F.col(value).alias("value"), middle.alias("middle"))

    out = one(0, 0, tables.even.withColumn("gram", F.lit(0)), "gram", "even")
    for k in range(1, ORDER + 1):
        out = out.unionByName(one(k, 0, tables.share[k], "gram", "share"))
        out = out.unionByName(one(k, 1, tables.left[k], "context", "left"))
    return out


def _model(rows: pa.Table) -> Model:
    """A part of a language's model."""
    level, kind, grams, values = (rows.column(c).to_numpy() for c in ("level", "kind", "gram", "value"))
    grams = grams.view(np.uint64)

    def pick(k: int, which: int, none: float) -> tuple[np.ndarray, np.ndarray]:
        own = (level == k) & (kind == which)
        order = np.argsort(grams[own])
        if not len(order):  # no n-gram nor context of a level above 1 is zero, so this row answers nothing
            return np.zeros(1, np.uint64), np.array([none])
        return grams[own][order], values[own][order]

    levels = [(*pick(k, 0, 0.0), *pick(k, 1, 1.0)) for k in range(1, ORDER + 1)]
    return Model.of_levels(levels, float(values[level == 0][0]))


class Models:
    """The models of all languages: ``langs`` by name, and ``shards``, broadcasts of [(lang, fold, part, parts, model)]."""

    def __init__(self, counts: DataFrame, shard_rows: int):
        spark = counts.sparkSession
        rows = save(_rows(Tables(counts, modified=False)))
        # Two numbers for each model.
        sizes = rows.groupBy("lang").agg(F.count("middle").alias("split"), F.count(F.lit(1)).alias("n")).collect()
        self.langs = sorted(r.lang.rpartition("/")[0] for r in sizes if r.lang.endswith("/all"))
        plan: list[list[tuple[str, int, int]]] = []
        room = 0
        for r in sorted(sizes):
            parts = max(1, -(-r.split // shard_rows))
            for part in range(parts):
                n = r.n - r.split + r.split // parts
                if not plan or n > room:
                    plan.append([])
                    room = shard_rows
                plan[-1].append((r.lang, part, parts))
                room -= n
        self.shards = []
        for shard in plan:
            # Of a model in several parts, a shard has one or a few.
            whole = [lang for lang, _, parts in shard if parts == 1]
            wanted = F.col("lang").isin(whole) if whole else F.lit(False)
            for lang, part, parts in shard:
                if parts > 1:
                    own = F.col("middle").isNull() | (F.col("middle") % parts == part)
                    wanted = wanted | ((F.col("lang") == lang) & own)
            held = rows.where(wanted).sort("lang").toArrow()
            names = held.column("lang").combine_chunks().dictionary_encode()
            number = names.indices.to_numpy()
            at = {name: k for k, name in enumerate(names.dictionary.to_pylist())}
            middle = held.column("middle").fill_null(-1).to_numpy()
            models = []
            for lang, part, parts in shard:
                own = (number == at[lang]) & ((middle < 0) | (middle % parts == part))
                name, _, fold = lang.rpartition("/")
                models.append((name, fold, part, parts, _model(held.filter(pa.array(own)))))
            self.shards.append(spark.sparkContext.broadcast(models))


def _label(id_col: str, text_col: str, lang_col: str) -> F.Column:
    """The language of a text that the models learn from, null for others."""
    return F.when(~held_out(F.col(f"`{id_col}`")) & F.col(f"`{text_col}`").isNotNull(), F.col(f"`{lang_col}`"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          shard_rows: int = SHARD_ROWS) -> Models:
    """Models for each language, from all texts that are not held out and carry a language."""
    learn = docs.where(_label(id_col, text_col, lang_col).isNotNull())
    return Models(gram_counts(learn.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))), shard_rows)


class _Slice:
    """Rows of a batch, and the sum of each text's log-probabilities under each language.

    ``unseen`` has those of a training text under its language's model of the other fold."""

    def __init__(self, part: pa.RecordBatch, text_at: int, langs: int, labels: list[str | None]):
        self.part = part
        lowered = _lowered(part.column(text_at).to_pylist())
        grams, self.counts = text_grams(lowered, letter_codes())
        # The texts that a fold's model judges.
        self.judged: dict[tuple[str, str], list[int]] = {}
        if any(x is not None for x in labels):
            for i, (lang, fold) in enumerate(zip(labels, _folds(lowered))):
                if lang is not None:
                    self.judged.setdefault((lang, str(1 - fold)), []).append(i)
        self.unseen = np.full(part.num_rows, np.nan)
        at, self.different = pd.factorize(grams)
        self.at = at.astype(np.int32)
        self.first = np.cumsum(self.counts) - self.counts
        self.sums = np.zeros((part.num_rows, langs))

    def add(self, k: int, part: int, parts: int, model: Model) -> None:
        if parts == 1:
            logs = model.log_probability(self.different)
        else:
            logs = np.zeros(len(self.different))
            own = _part(self.different, parts) == part
            logs[own] = model.log_probability(self.different[own])
        self.sums[:, k] += np.add.reduceat(logs[self.at], self.first)

    def cross(self, lang: str, fold: str, part: int, parts: int, model: Model) -> None:
        rows = self.judged.get((lang, fold))
        if rows is None:
            return
        chosen = np.zeros(len(self.counts), bool)
        chosen[rows] = True
        at = self.at[np.repeat(chosen, self.counts)]
        own = np.zeros(len(self.different), bool)
        own[at] = True
        if parts > 1:
            own &= _part(self.different, parts) == part
        logs = np.zeros(len(self.different))
        logs[own] = model.log_probability(self.different[own])
        counts = self.counts[chosen]
        sums = np.add.reduceat(logs[at], np.cumsum(counts) - counts)
        self.unseen[chosen] = np.where(np.isnan(self.unseen[chosen]), 0.0, self.unseen[chosen]) + sums


def _groups(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices in lists of about ``most`` bytes (one slice at least)."""
    group, held = [], 0
    for part in parts:
        group.append(part)
        held += part.nbytes
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def scores(docs: DataFrame, models: Models, text_col: str, label: F.Column | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``cross_entropy``, ``letters`` appended (columns of
    these names are replaced).

    ``score`` is the share of the predicted language, from 0 to 1, if the languages' shares
    are in proportion to their probabilities per character.  With ``label``, the languages of the
    training texts, there is ``unseen_entropy`` too: a training text's cross-entropy under its own
    language's model of the other fold.  It takes no part in the prediction."""
    bound_batches(docs.sparkSession)
    langs, shards = models.langs, models.shards
    number = {lang: k for k, lang in enumerate(langs)}
    new = ["lang_pred", "score", "cross_entropy", "letters", "unseen_entropy"][:4 if label is None else 5]
    names = [c for c in docs.columns if c not in new]
    text_at = names.index(text_col)
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields)
    labelled = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                           (F.lit(None) if label is None else label).cast("string").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(slices(batches, f"c{text_at}"), CHUNK_BYTES if len(shards) > 1 else 1):
            held = [_Slice(part.select(part.schema.names[:-1]), text_at, len(langs), part.column(part.num_columns - 1).to_pylist())
                    for part in group]
            for shard in shards:
                for lang, fold, part, parts, model in shard.value:
                    for one in held:
                        if fold == "all":
                            one.add(number[lang], part, parts, model)
                        else:
                            one.cross(lang, fold, part, parts, model)
                if len(shards) > 1:
                    vars(shard).pop("_value", None)  # read again from the worker's disk with the next group
            for one in held:
                yield finish(one)

    def finish(one: _Slice) -> pa.RecordBatch:
        counts, part = one.counts, one.part
        entropy = -one.sums / counts[:, None]
        letters = counts - 1  # with the boundaries between words; none without a letter
        known = (letters > 0) & (len(langs) > 0)
        best = entropy.argmin(axis=1) if langs else np.zeros(len(counts), int)
        low = entropy[np.arange(len(counts)), best] if langs else np.zeros(len(counts))
        share = np.zeros(len(counts))
        if langs:
            share = 1 / np.exp(low[:, None] - entropy).sum(axis=1)
        pred = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
        columns = [pa.array(pred, pa.string()), pa.array(np.where(known, share, 0.0)),
                   pa.array(np.where(known, low, np.nan), from_pandas=True), pa.array(letters, pa.int64()),
                   pa.array(-one.unseen / counts, from_pandas=True)]
        return pa.RecordBatch.from_arrays([*part.columns, *columns[:len(new)]], names=[*part.schema.names, *new])

    kinds = ["string", "double", "double", "long", "double"]
    out = labelled.mapInArrow(run, ", ".join([schema, *(f"{n} {k}" for n, k in zip(new, kinds))]))
    return out.toDF(*names, *new)


def _length_class() -> F.Column:
    return F.floor(F.log2(F.col("letters"))).cast("int")


def limits(scored: DataFrame, lang_col: str) -> dict[str, list[float]]:
    """For each language, by length class: the highest cross-entropy that is accepted.

    From all training texts whose language was recognised, each judged by the other fold's model.  Median and
    third quartile set the limit, so junk that is less than a quarter of a class does not move it far.  A class with
    few texts has the limit of the whole language, widened the more the shorter its texts are; a
    language with few has the most lenient limit of any other; nothing is rejected only if none has enough."""
    right = scored.where((F.col(lang_col) == F.col("lang_pred")) & F.col("unseen_entropy").isNotNull())
    quartiles = [F.count(F.lit(1)).alias("n"), F.percentile_approx("unseen_entropy", [0.5, 0.75], 100_000).alias("q"),
                 F.percentile_approx("letters", 0.5, 100_000).alias("letters")]
    classes = right.groupBy("lang_pred", _length_class().alias("size")).agg(*quartiles).collect()
    whole = right.groupBy("lang_pred").agg(*quartiles).collect()

    def slack(q: list[float]) -> float:
        return SLACK * max(q[1] - q[0], LEAST_SPREAD * q[0])

    out: dict[str, list[float]] = {}
    for r in whole:
        if r.n >= SUPPORT:
            out[r.lang_pred] = [r.q[0] + slack(r.q) * max(1.0, r.letters / 2.0**size) ** WIDEN for size in range(64)]
    for r in classes:
        if r.n >= SUPPORT:
            out[r.lang_pred][r.size] = r.q[0] + slack(r.q)
    if out:
        lenient = [max(row[size] for row in out.values()) for size in range(64)]
        out[REST] = lenient
    return out


def _accepted(found: dict[str, list[float]]) -> F.Column:
    rest = F.lit(None).cast("double")
    limit = None
    for lang, row in found.items():
        own = F.element_at(F.array(*[F.lit(x).cast("double") for x in row]), _length_class() + 1)
        if lang == REST:
            rest = own
        else:
            limit = F.when(F.col("lang_pred") == lang, own) if limit is None else limit.when(F.col("lang_pred") == lang, own)
    limit = rest if limit is None else limit.otherwise(rest)
    return (F.col("lang_pred") != UNKNOWN) & ~F.coalesce(F.col("cross_entropy") > limit, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its id, ``held_out``, ``lang_pred``, ``score``, ``cross_entropy``, ``accepted``.

    The language column, the id and all others take no part in a prediction.  A null text, or one without a letter,
    is ``und`` with score 0, no cross-entropy, and not accepted; so is every text where no training text carries
    a language.  Of languages with the same cross-entropy the first by name is taken.  Repeated rows get the
    same prediction; an empty table gives an empty result."""
    models = train(docs, id_col, text_col, lang_col)
    part = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    scored = save(scores(part, models, "text", _label("id", "text", "lang")).drop("text"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score",
                         "cross_entropy", _accepted(limits(scored, "lang")).alias("accepted"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that ``identify`` does not accept, with all columns of ``docs``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    i, t, lang = (names[docs.columns.index(c)] for c in (id_col, text_col, lang_col))
    scored = save(scores(plain, train(docs, id_col, text_col, lang_col), t, _label(i, t, lang)))
    return scored.where(_accepted(limits(scored, lang))).select(*names).toDF(*docs.columns)
