"""Quality classifier: perplexity under an n-gram model of trusted text.

For each language an interpolated modified Kneser-Ney model of character 4-grams is estimated from
trusted documents.  Counts, contexts and backed-off probabilities are tables, joined shard by shard on
language and n-gram; the driver sees counts of counts only.

Scoring brings the model to the documents.  A task cuts its documents into chunks of bounded size and
writes for each chunk its different n-grams.  These are joined with the model's tables, order by
order, and each chunk gets the probabilities of its n-grams back.  What travels is a chunk's compressed rows
and different n-grams, never a row for each character.

A document is kept if its perplexity is at most a high quantile of that of trusted documents in its
language that the model has not seen.  A language with few of these uses their median and the spread of
all languages; any other text is judged by a model and a quantile pooled over all languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, forget, give_back, save, slices
from alertlake.llm.grams import BITS, ORDER, Tally, discounts, text_grams, visible_codes

#: The quantile of unseen trusted documents' perplexity, by language, up to which a document is kept.
QUANTILE = 0.98
#: A language with fewer unseen trusted documents has no quantile of its own, with fewer than the second not even a median.
SUPPORT = 50
MEDIAN_SUPPORT = 10
#: A threshold is at least so many distances from median to third quartile above the median: where trusted documents are
#: all alike, the quantile would cut into their usual spread.
SPREAD = 3.5
#: The name under which the model pooled over all languages stands.
POOL = "<pool>"
#: What a text under the pooled model may cost, in nats, whatever its length: some ten characters that the model has not
#: seen.  A few words in an unknown language cannot be told from noise; thirty characters of noise can.
ALLOWANCE = 50.0
#: Bytes of text in a chunk.
CHUNK_BYTES = 12 << 20
#: Bytes of text whose n-grams a task holds at once.
PART_BYTES = 1 << 19
#: Compression of the tables of n-grams, the larger part of what lies on disk.
CODEC = "zstd"


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def _by_language(batch: pa.RecordBatch, lang: str, text: str) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """The n-grams of a batch; its languages; each n-gram's language's number; n-grams of each text."""
    grams, counts = text_grams(_texts(batch, text), visible_codes())
    number, names = pd.factorize(np.array([x or "" for x in batch.column(lang).to_pylist()], object))
    return grams, list(names), np.repeat(number, counts), counts


def _counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for part in slices(batches, text, PART_BYTES):
            grams, names, number, _ = _by_language(part, lang, text)
            for i, name in enumerate(names):
                tallies.setdefault(name, Tally()).add(grams[number == i])
        for name, tally in tallies.items():
            grams, counts = tally.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"])

    return (docs.select(lang, text).mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _end(gram: str, order: int) -> F.Column:
    """The last ``order`` characters of an n-gram."""
    mask = (1 << BITS * order) - 1
    return F.col(gram) if order == ORDER else F.col(gram).bitwiseAND(F.lit(mask))


def _context(gram: str, order: int) -> F.Column:
    """An n-gram of that order without its last character."""
    return F.shiftrightunsigned(_end(gram, order), BITS)


class Tables:
    """The model as tables: for each order (lang, gram, share) and (lang, context, left).

    ``share`` is an n-gram's discounted count over its context's total, ``left`` the weight that a context
    leaves to the next lower order.  ``even`` (lang, even) is the equal share below the lowest order.
    ``saved`` says that ``counts`` is read from tables already."""

    def __init__(self, counts: DataFrame, modified: bool = True, saved: bool = False):
        spark = counts.sparkSession
        self.share: dict[int, DataFrame] = {}
        self.left: dict[int, DataFrame] = {}
        n = counts if saved else save(counts, codec=CODEC)
        for order in range(ORDER, 0, -1):
            times = n.groupBy("lang").agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)])
            rows = [(r.lang, *map(float, discounts([r.n1, r.n2, r.n3, r.n4], modified)[1:]))
                    for r in times.collect()]  # four numbers for each language
            off = spark.createDataFrame(rows, "lang string, d1 double, d2 double, d3 double")
            own = n.join(F.broadcast(off), "lang").select(
                "lang", "gram", "n", _context("gram", order).alias("context"),
                F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("off"))
            contexts = save(own.groupBy("lang", "context").agg(
                F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("left")), codec=CODEC)
            self.share[order] = own.join(contexts, ["lang", "context"]).select(
                "lang", "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("share"))
            self.left[order] = contexts.select("lang", "context", "left")
            if order > 1:
                n = save(n.groupBy("lang", _end("gram", order - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")), codec=CODEC)
        self.even = n.groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("even"))

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """(lang, gram, p) for different (lang, gram); p is null in a language without a model."""
        return self._order(wanted, ORDER)

    def _order(self, wanted: DataFrame, order: int) -> DataFrame:
        rows = wanted.withColumn("lower", _end("gram", order - 1) if order > 1 else F.lit(0).cast("long"))
        if order == 1:
            lower = self.even.withColumnRenamed("even", "low")
            rows = rows.join(lower, "lang", "left")
        else:
            lower = self._order(rows.select("lang", F.col("lower").alias("gram")).distinct(), order - 1)
            rows = rows.join(lower.select("lang", F.col("gram").alias("lower"), F.col("p").alias("low")), ["lang", "lower"])
        rows = rows.withColumn("context", _context("gram", order))
        rows = rows.join(self.left[order], ["lang", "context"], "left").join(self.share[order], ["lang", "gram"], "left")
        return rows.select("lang", "gram", (
            F.coalesce("share", F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * F.col("low")).alias("p"))


def _chunks(batches: Iterator[pa.RecordBatch], text: str, chunk_bytes: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """A task's rows cut into numbered chunks; the same rows give the same chunks each time."""
    number, parts, held = TaskContext.get().partitionId() << 33, [], 0
    for part in slices(batches, text, PART_BYTES):
        parts.append(part)
        held += part.nbytes
        if held >= chunk_bytes:
            yield number, parts
            number, parts, held = number + 1, [], 0
    if parts:
        yield number, parts


def _wanted(lang: str, text: str, chunk_bytes: int):
    """(chunk, lang, gram): the different n-grams of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, parts in _chunks(batches, text, chunk_bytes):
            seen: dict[str, list[np.ndarray]] = {}
            for part in parts:
                grams, names, of, _ = _by_language(part, lang, text)
                for i, name in enumerate(names):
                    seen.setdefault(name, []).append(pd.unique(grams[of == i]))
            for name, lists in seen.items():
                grams = np.sort(pd.unique(np.concatenate(lists)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), number)), pa.array([name] * len(grams), pa.string()), pa.array(grams)],
                    names=["chunk", "lang", "gram"])

    return run


def _packed(text: str, chunk_bytes: int):
    """(chunk, rows): the rows of each chunk, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        for number, parts in _chunks(batches, text, chunk_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=options) as out:
                for p in parts:
                    out.write_batch(p)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["chunk", "rows"])

    return run


def _score(lang: str, text: str):
    """A chunk's rows with their perplexity, from the probabilities of its n-grams."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        names = answers.column("lang").to_pylist()
        model = {}
        for name, grams, logs in zip(names, answers.column("grams"), answers.column("logs")):
            at = model.setdefault(name, ([], []))
            at[0].append(grams.values.to_numpy())
            at[1].append(logs.values.to_numpy(zero_copy_only=False))
        for name, (grams, logs) in model.items():
            grams, logs = np.concatenate(grams), np.concatenate(logs)
            order = np.argsort(grams)
            model[name] = grams[order], logs[order]
        out = []
        for rows in chunk.column("rows"):
            for batch in pa.ipc.open_stream(rows.as_buffer()):
                grams, langs, of, counts = _by_language(batch, lang, text)
                logs = np.empty(len(grams))
                for i, name in enumerate(langs):
                    own = of == i
                    at, different = pd.factorize(grams[own].view(np.int64))
                    known, values = model[name]
                    place = np.minimum(np.searchsorted(known, different), len(known) - 1)
                    if np.any(known[place] != different):
                        raise ValueError("the table changed between its two readings; write it down first")
                    logs[own] = values[place][at]
                first = np.cumsum(counts) - counts
                mean = -np.add.reduceat(logs, first) / counts
                perplexity = np.where(counts > 1, np.exp(mean), np.nan)
                out.append(pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(perplexity, from_pandas=True), pa.array(counts - 1, pa.int64())],
                    names=[*batch.schema.names, "perplexity", "n_chars_scored"]))
        give_back()
        return pa.Table.from_batches(out)

    return run


def perplexities(docs: DataFrame, model: Tables, lang: str, text: str, keep: list[str],
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A table of the columns ``keep`` of ``docs`` with ``perplexity`` and ``n_chars_scored``.

    What it is made from is removed when it is written.  ``docs`` is read twice, in the same order, as a written table is; if it is not, the job fails.  A text
    without a visible character has no perplexity, nor has any in a language without a model."""
    bound_batches(docs.sparkSession)
    wanted = save(docs.mapInArrow(_wanted(lang, text, chunk_bytes), "chunk long, lang string, gram long"), codec=CODEC)
    found = save(model.probabilities(wanted.select("lang", "gram").distinct()), codec=CODEC)
    answers = (wanted.join(found, ["lang", "gram"])
               .groupBy("chunk", "lang", F.pmod(F.xxhash64("gram"), F.lit(16)).alias("part"))
               .agg(F.collect_list(F.struct("gram", F.log("p").alias("log"))).alias("all"))
               .select(F.col("chunk").alias("of"), "lang", F.col("all.gram").alias("grams"),
                      F.transform("all", lambda x: x["log"]).alias("logs")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = (docs.mapInArrow(_packed(text, chunk_bytes), "chunk long, rows binary").groupBy("chunk")
              .cogroup(answers.groupBy("of"))
              .applyInArrow(_score(lang, text), f"{schema}, perplexity double, n_chars_scored long"))
    done = save(scored.select(*keep, "perplexity", "n_chars_scored"), codec=CODEC)
    forget(wanted)
    forget(found)
    return done


def _judged(docs: DataFrame, trusted: DataFrame, i: str, lang: str, text: str, keep: list[str],
            quantile: float) -> DataFrame:
    """``keep`` with perplexity, threshold and ``kept``; ``trusted`` has one column, ids."""
    spark = docs.sparkSession
    # Saved, so that Spark knows their size: it broadcasts few ids and else shuffles the texts of that half by id.
    ids = save(trusted.select(F.col(trusted.columns[0]).alias(i)).where(F.col(i).isNotNull()).distinct())
    # One half of the trusted documents teaches the model, the other half sets the thresholds.
    half = F.crc32(F.col(i).cast("string").cast("binary")) % 2 == 0
    fit = docs.where(half).join(ids.where(half), i, "left_semi")
    counts = save(_counts(fit, lang, text), codec=CODEC)
    pooled = save(counts.groupBy(F.lit(POOL).alias("lang"), "gram").agg(F.sum("n").alias("n")), codec=CODEC)
    model = Tables(counts.unionByName(pooled), saved=True)
    scored = perplexities(docs, model, lang, text, keep)
    own = F.coalesce(F.col(lang), F.lit(""))
    unseen = (scored.where("perplexity is not null").select(i, own.alias("own"), "perplexity")
              .join(ids.where(~half), i, "left_semi"))
    q = F.percentile_approx("perplexity", [quantile, 0.5, 0.75], 100_000)
    limits = unseen.groupBy("own").agg(q.alias("q"), F.count(F.lit(1)).alias("n")).select(
        "own", "n", F.col("q")[1].alias("median"),
        F.greatest(F.col("q")[0], F.col("q")[1] + SPREAD * (F.col("q")[2] - F.col("q")[1])).alias("threshold"))
    # One row for each language with enough documents, so at most their number / MEDIAN_SUPPORT: read once and
    # broadcast, or the texts would be shuffled by language.
    rows = limits.where(F.col("n") >= MEDIAN_SUPPORT).collect()
    if any(r.n < SUPPORT for r in rows):
        medians = F.broadcast(spark.createDataFrame([(r.own, r.median) for r in rows], "own string, median double"))
        spread = unseen.join(medians, "own").agg(
            F.percentile_approx(F.col("perplexity") / F.col("median"), quantile, 100_000)).first()[0]
    found = [(r.own, r.threshold if r.n >= SUPPORT else r.median * spread) for r in rows]
    limits = spark.createDataFrame(found, "own string, threshold double")
    kept = (F.col("n_chars_scored") > 0) & (F.col("perplexity") <= F.col("threshold"))
    judged = scored.withColumn("own", own).join(F.broadcast(limits), "own").drop("own").withColumn("kept", kept)
    other = ~own.isin([x for x, _ in found])
    if scored.where(other).isEmpty():
        return judged
    return judged.unionByName(_by_pool(docs.where(other), docs.where(~half).join(ids.where(~half), i, "left_semi"),
                                       model, lang, text, keep, quantile))


def _by_pool(docs: DataFrame, unseen: DataFrame, model: Tables, lang: str, text: str, keep: list[str],
             quantile: float) -> DataFrame:
    """``docs`` judged by the pooled model and the quantile of all unseen trusted documents of all languages.

    ``perplexity`` is that of the language's own model, if there is one; ``threshold`` is null."""
    held = save(unseen.select(F.lit(POOL).alias("pool"), text), codec=CODEC)
    limit = (perplexities(held, model, "pool", text, ["pool"])
             .agg(F.percentile_approx(F.log("perplexity"), quantile, 100_000)).first()[0])
    forget(held)
    scored = (perplexities(docs, model, lang, text, docs.columns).drop("n_chars_scored")
              .withColumnRenamed("perplexity", "own perplexity").withColumn("pool", F.lit(POOL)))
    scored = perplexities(scored, model, "pool", text, [*keep, "own perplexity"])
    # Without any unseen trusted document there is nothing to judge by.
    excess = F.log("perplexity") - F.lit(limit).cast("double") - ALLOWANCE / (F.col("n_chars_scored") + 1)
    return scored.select(*keep, F.col("own perplexity").alias("perplexity"), "n_chars_scored",
                         F.lit(None).cast("double").alias("threshold"),
                         ((F.col("n_chars_scored") > 0) & F.coalesce(excess <= 0, F.lit(True))).alias("kept"))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             quantile: float = QUANTILE) -> DataFrame:
    """One row per row of ``docs``: its id, ``lang``, ``perplexity``, ``threshold``, ``kept``.

    ``trusted`` holds the ids of trusted documents in its first column.  A null or blank text has no
    perplexity and is not kept.  A null language is a language of its own.  A text in a language without trusted text has
    no perplexity.  One in a language with fewer than ``MEDIAN_SUPPORT`` unseen trusted documents has no threshold; the
    pooled model judges it (see ``ALLOWANCE``).  It is kept unjudged only if no document of any language is trusted and
    unseen.  Repeated rows get equal results; other columns are not read; an empty table gives an empty result."""
    part = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    judged = _judged(part, trusted, "id", "lang", "text", ["id", "lang"], quantile)
    return judged.select(F.col("id").alias(id_col), "lang", "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              quantile: float = QUANTILE) -> DataFrame:
    """``docs`` without the rows that ``classify`` does not keep, with all columns of ``docs``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    i, text, lang = (names[docs.columns.index(c)] for c in (id_col, text_col, lang_col))
    judged = _judged(docs.toDF(*names), trusted, i, lang, text, names, quantile)
    return judged.where("kept").select(*names).toDF(*docs.columns)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
