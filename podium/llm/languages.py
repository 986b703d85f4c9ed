"""Language identification by Bayesian evidence fusion.

The text's likelihood under every language comes from byte trigrams, learnt from a bounded sample of each
language's labelled rows. It is fused with what surrounds the text: the language its markup declares, and the
host's own mix of languages, smoothed towards the mix of the host's address suffix and that towards the
mix of the whole corpus. Mixes and the reliability of declarations are counted over all rows, by grouped
aggregation on the languages that the texts alone suggest; a row's own vote is left out of its host's.

A text in no known language is ``und``, modelled as trigrams without preference. Rejected are rows whose
best language is ``und``, or whose posterior is under one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import slices, stored
from podium.llm.tokens import forget_words

SAMPLE = 4000  # labelled rows that the trigram model is fitted on, at most
BUCKETS = 1 << 15
TEMPER = 0.2  # trigrams overlap; their joint weight is reduced to that of independent evidence
SMOOTHING = 10.0
UND = "und"
UND_PRIOR = 0.01
_PIECE = 1 << 18


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all byte trigrams of the lower-cased text, in pieces."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    for start in range(0, max(len(data) - 2, 0), _PIECE):
        piece = data[start:start + _PIECE + 2]
        code = (piece[:-2] << np.uint32(16)) | (piece[1:-1] << np.uint32(8)) | piece[2:]
        yield (code * np.uint32(2654435761)) >> np.uint32(17)


def _even_share(sizes: list[int], sample: int) -> int:
    """Largest number of rows per label with which all labels together have at most ``sample``, one at least."""
    left = sample
    for k, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - k)
        if size > share:
            return max(1, share)
        left -= size
    return max(sizes, default=1)


def _sampled(rows: DataFrame, sample: int) -> DataFrame:
    """``label``, ``text`` of the distinct rows with each label's smallest draws, as many as its even share."""
    drawn = stored(rows.select("label", "draw").distinct(), "draws")
    sizes = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows.select("label", "text")
    share = _even_share(list(sizes.values()), sample)
    # Draws are even over all long integers: what lies under this part of them holds the share, and little more.
    part = {label: min(1.0, (share + 6 * share ** 0.5 + 10) / n) for label, n in sizes.items()}
    low = F.create_map(*[F.lit(x) for label, p in part.items() for x in (label, p * 2.0 ** 64 - 2.0 ** 63)])
    each = F.row_number().over(Window.partitionBy("label").orderBy("draw"))
    cuts = (drawn.filter(F.col("draw").cast("double") <= F.element_at(low, F.col("label")))
            .withColumn("place", each).filter(F.col("place") <= share)
            .groupBy("label").agg(F.max("draw").alias("cut")).collect())
    cut = F.map_from_arrays(F.lit([r["label"] for r in cuts]), F.lit([r["cut"] for r in cuts]).cast("array<bigint>"))
    return rows.filter(F.col("draw") <= F.element_at(cut, F.col("label"))).select("label", "text").dropDuplicates()


def fitted(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities per bucket, ``und`` last.

    ``labelled`` has ``text`` and ``label``. The languages are the labels of all rows. The sample holds at most
    ``sample`` distinct rows, those with the smallest hashes of both within their label: labels share it evenly,
    what one does not need goes to the others, and each has a row at least, however many there are. Counts are
    added up on the executors; the driver gets one row per language and bucket.
    """
    rows = (labelled.filter("text IS NOT NULL AND label IS NOT NULL AND text != '' AND label != ''")
            .filter(F.col("label") != UND).select("label", "text", F.xxhash64("text", "label").alias("draw")))
    chosen = _sampled(rows, sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = totals.setdefault(label, np.zeros(BUCKETS, np.int64))
                for codes in trigrams(text):
                    total += np.bincount(codes, minlength=BUCKETS)
        for label, total in totals.items():
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(found), pa.string()), pa.array(found), pa.array(total[found])],
                                             ["label", "bucket", "n"])

    counted = (chosen.mapInArrow(count, "label string, bucket bigint, n bigint")
               .groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect())
    languages = sorted({r["label"] for r in counted})
    place = {label: k for k, label in enumerate(languages)}
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    for r in counted:
        table[place[r["label"]], r["bucket"]] += r["n"]
    table[-1] = 1.0
    return [*languages, UND], np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _text_scores(languages: list[str], table: np.ndarray):
    """A vectorised function from texts to log likelihoods, tempered; null without any trigram."""
    columns = np.ascontiguousarray(table.T)

    def scores(texts):
        forget_words()
        out = []
        for value in texts:
            text, total, n = value.as_py(), np.zeros(len(languages)), 0
            for codes in trigrams(text) if text and text.strip() else ():
                total += columns[codes].sum(axis=0, dtype=np.float64)
                n += len(codes)
            out.append(total * TEMPER if n else None)
        return pa.array(out, pa.list_(pa.float64()))

    return F.arrow_udf(scores, "array<double>")


def suffix_of(host: Column) -> Column:
    """Last label of a host name, the host itself if it has none."""
    return F.substring_index(host, ".", -1)


def fused(rows: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """``rows`` (``text``, ``declared``, ``host``, and any others) with ``language`` and ``confidence``.

    Null evidence says nothing: a row without declaration or host goes by the rest. Hosts, suffixes and
    declarations are joined as aggregated tables; the rows with their texts are not grouped.
    """
    n_languages = len(languages)
    scored = rows.withColumn("suffix", suffix_of(F.col("host"))).withColumn("scores", _text_scores(languages, table)("text"))
    voted = scored.withColumn("vote", F.when(F.col("scores").isNotNull(), F.array_position("scores", F.array_max("scores")).cast("int") - 1))
    votes = stored(voted.filter("vote IS NOT NULL").groupBy("host", "suffix", "declared", "vote").agg(F.count("*").alias("n")), "votes")

    def counts(key: str, name: str) -> DataFrame:
        """Votes for every language, in their order, per value of ``key``: one short array each."""
        by_vote = votes.filter(F.col(key).isNotNull()).groupBy(key, "vote").agg(F.sum("n").cast("double").alias("n"))
        found = by_vote.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("vote", "n"))).alias("found"))
        places = F.sequence(F.lit(0), F.lit(n_languages - 1))
        return found.select(key, F.transform(places, lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0.0))).alias(name))

    overall = np.zeros(n_languages)
    for r in votes.groupBy("vote").agg(F.sum("n").alias("n")).collect():  # a row per language
        overall[r["vote"]] = r["n"]
    suffixes = counts("suffix", "by_suffix")
    hosts = counts("host", "by_host").withColumn("suffix", suffix_of(F.col("host"))).join(suffixes, "suffix").drop("suffix")
    declarations = counts("declared", "by_declared")
    judge = F.arrow_udf(_judge(languages, overall, max(1, declarations.count())), "struct<best int, confidence double>")
    joined = voted.join(hosts, "host", "left").join(declarations, "declared", "left")
    judged = joined.withColumn("judged", judge("scores", "vote", "by_host", "by_suffix", "by_declared", F.col("declared").isNotNull()))
    named = F.element_at(F.array(*map(F.lit, languages)), F.col("judged.best") + 1)
    return (judged.withColumn("language", F.when(F.col("judged.best").isNull(), F.lit(UND)).otherwise(named))
            .withColumn("confidence", F.coalesce("judged.confidence", F.lit(0.0))))


def posteriors(scores: np.ndarray, vote: np.ndarray, by_host: np.ndarray, by_suffix: np.ndarray, by_declared: np.ndarray,
               said: np.ndarray, overall: np.ndarray, base: np.ndarray, kinds: int) -> np.ndarray:
    """Log posteriors, up to a constant a row: text, then the smoothed mix of host, suffix and corpus, then what is declared.

    A row a text, a column a language; ``vote`` marks a row's own vote, which its host, suffix and declaration do without.
    """
    def without_own(counts: np.ndarray) -> np.ndarray:
        return np.maximum(counts - vote, 0.0)

    def mix(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
        left = without_own(counts)
        return (left + SMOOTHING * parent) / (left.sum(axis=1, keepdims=True) + SMOOTHING)

    corpus = (overall + SMOOTHING * base) / (overall.sum() + SMOOTHING)
    declared = np.log((without_own(by_declared) + 1.0 / kinds) / (without_own(overall[None, :]) + 1.0))
    return scores + np.log(mix(by_host, mix(by_suffix, corpus))) + declared * said[:, None]


def _judge(languages: list[str], overall: np.ndarray, kinds: int):
    width = len(languages)
    base = np.array([UND_PRIOR if name == UND else (1 - UND_PRIOR) / max(1, width - 1) for name in languages])

    def matrix(lists: pa.Array) -> np.ndarray:
        out = np.zeros((len(lists), width))
        out[~lists.is_null().to_numpy(zero_copy_only=False)] = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return out

    def judge(scores, vote, by_host, by_suffix, by_declared, said):
        known = ~scores.is_null().to_numpy(zero_copy_only=False)
        places = np.arange(width)[None, :] == vote.fill_null(-1).to_numpy(zero_copy_only=False)[:, None]
        log = posteriors(matrix(scores), places.astype(float), matrix(by_host), matrix(by_suffix), matrix(by_declared),
                         said.to_numpy(zero_copy_only=False).astype(float), overall, base, kinds)
        best = log.argmax(axis=1)
        mass = np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32), mask=~known), pa.array(1 / mass, mask=~known)],
                                          ["best", "confidence"])
    return judge


def _evidence(docs: DataFrame, declared: str | None, host: str | None, *carried: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return docs.select(*carried, F.col("text").alias("text"),
                       (F.lower(F.col(declared).cast("string")) if declared else nothing).alias("declared"),
                       (F.lower(F.col(host).cast("string")) if host else nothing).alias("host"))


def _model(docs: DataFrame, label: str, sample: int) -> tuple[list[str], np.ndarray]:
    return fitted(docs.select("text", F.lower(F.col(label).cast("string")).alias("label")), sample)


def identify(docs: DataFrame, declared: str = "lang", host: str = "source", sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``language``, ``confidence`` and ``rejected`` of every row.

    The declared language also labels the sample. Texts that are null, empty or white space are ``und``
    with confidence 0 and rejected. Repeated rows are judged alike, apart from each leaving out its own
    vote; ties go to the first language in code point order; without a labelled row all are rejected;
    an empty table gives no rows; extra columns are not read.
    """
    languages, table = _model(docs, declared, sample)
    rows = _evidence(docs, declared, host, F.col("doc_id").cast("bigint").alias("doc_id"))
    return fused(rows, languages, table).select("doc_id", "language", "confidence", _rejected().alias("rejected"))


def _rejected() -> Column:
    return (F.col("language") == UND) | (F.col("confidence") < 0.5)


def accepted(docs: DataFrame, declared: str = "lang", host: str = "source", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all their columns, that :func:`identify` does not reject.

    Rows are judged one by one by what they hold: nulls and empty texts as :func:`identify` says, repeated rows stay or go
    together, an empty table gives no rows; further columns, whatever their names, pass unread.
    """
    languages, table = _model(docs, declared, sample)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return (fused(_evidence(docs, declared, host, whole), languages, table).filter(~_rejected())
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def identify_pages(pages: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """The same for raw pages: ``page_id``, ``language``, ``confidence``, ``rejected``.

    Declared is the ``lang`` of the html element, the host and its suffix come from the address, the
    text is the page without scripts, styles and tags. A null page is an empty text without a declared language, a
    null or unreadable address one without host or suffix; what is absent gives no evidence. Repeated rows repeat
    theirs, ids may be null, an empty table gives no rows, and further columns are not read.
    """
    html = F.col("html")
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    declared = F.lower(F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1), F.lit("")))
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit("")))
    rows = pages.select("page_id", plain.alias("text"), declared.alias("declared"), host.alias("host"))
    return fused(rows, languages, table).select("page_id", "language", "confidence", _rejected().alias("rejected"))
