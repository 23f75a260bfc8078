"""Operator 8: language identification by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.html import ARTICLE, OPEN, blocks, host_of
from tillroll.llm.tables import map_batches, table, written
from tillroll.operators.lookup import join_lookup
from tillroll.scratch import materialise

SAMPLE_ROWS = 8_000       # labelled documents that the text model is trained on, shared out evenly among the languages
LEAST_ROWS = 40           # of each language, as far as there are
BUCKETS = 1 << 14         # hashed trigrams of characters
UNKNOWN = "und"

EVIDENCE_CHARS = 200      # a text of any length counts as so many independent trigrams at most
TEMPER = 0.2              # neighbouring trigrams overlap and depend on each other
HOST_WEIGHT = 5.0         # pages that a host's prior borrows from the level above
DECLARED_WEIGHT = 5.0     # the same for how far declarations are believed
LEAST_PROBABILITY = 0.5

_LETTERS = np.array([chr(c).isalpha() for c in range(0x3000)])


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of trigrams: one row per bucket, one column per language."""

    languages: tuple[str, ...]
    logs: np.ndarray


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams of the lower-case letters, runs of anything else being one space each."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _LETTERS[np.minimum(codes, 0x2FFF)] | (codes >= 0x3000)
    if not letters.any():
        return np.zeros(0, np.int64)
    kept = letters.copy()
    kept[1:] |= letters[:-1]  # the first of a run stands for it
    codes = np.concatenate([[32], np.where(letters, codes, 32)[kept], [32]]).astype(np.uint64)
    codes = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA77) + codes[2:]
    return ((codes * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)


def train(docs: DataFrame, label: str = "lang", rows: int = SAMPLE_ROWS) -> TextModel:
    """A text model from about ``rows`` documents (doc_id, text, ``label``), chosen by a hash of the id.

    Languages are counted over all documents. Each has an even share of ``rows``, ``LEAST_ROWS`` at least: one with
    fewer documents learns from all of them. Counts are summed in Spark; the driver gets one row and at most
    ``BUCKETS`` numbers for each language.
    """
    known = docs.filter(F.col(label).isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", "text", F.col(label).alias("label"))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    share = max(LEAST_ROWS, rows // max(len(sizes), 1))
    # No row of a language that has its share or less is left out; the others are thinned by the hash.
    shares = docs.sparkSession.createDataFrame(
        [(row["label"], min(1.0, share / row["n"])) for row in sizes], known.select("label").schema.add("share", "double"))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.col("share") * (1 << 32)
    sample = known.join(F.broadcast(shares), "label").filter(drawn).select("text", "label")

    def counted(batch: dict[str, list]) -> dict[str, list]:
        counts: dict[str, np.ndarray] = {}
        for text, language in zip(batch["text"], batch["label"], strict=True):
            counts.setdefault(language, np.zeros(BUCKETS, np.int64))
            counts[language] += np.bincount(trigrams(text), minlength=BUCKETS)
        return {"label": list(counts), "counts": pa.array(list(counts.values()), pa.list_(pa.int64()))}

    summed = map_batches(sample, counted, "label string, counts array<long>").select(
        "label", F.posexplode("counts").alias("bucket", "n")).filter("n > 0").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toPandas()
    languages = tuple(sorted(found.label.unique()))  # those with a letter
    logs = np.full((BUCKETS, len(languages)), 0.1)
    for column, language in enumerate(languages):
        own = found[found.label == language]
        logs[own.bucket.to_numpy(), column] += own.n.to_numpy()
    return TextModel(languages, np.log(logs / logs.sum(0)).astype(np.float32))


def text_evidence(model: TextModel, text: str | None) -> list[float]:
    """Tempered log likelihoods of the languages against that of letters in any order; empty without letters."""
    found = trigrams(text)
    if not len(found) or not model.languages:
        return []
    mean = model.logs[found].mean(0) - np.log(1 / BUCKETS)
    return (mean * TEMPER * min(len(found), EVIDENCE_CHARS)).astype(float).tolist()


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def identify(rows: DataFrame, model: TextModel, text_of=None) -> DataFrame:
    """Language and probability for each of ``rows`` (text, declared, host, site, suffix, and any others).

    The posterior combines the likelihood of the text; that of the declared language, given how often texts of each
    language declare it; and the host's prior, which borrows from that of its site, which borrows from that of the
    address suffix, which borrows from that of all rows. These are sums of text posteriors over all rows, by grouped
    aggregation; a row's own part is taken out of its host's. ``language`` is ``und`` where the text has no letters, or
    fits every language less than letters in any order, or no language has ``LEAST_PROBABILITY``. Null declarations say
    nothing; null hosts, sites and suffixes are values like others. No rows: no rows.

    Adds text_language, language, probability; ``text`` itself goes. ``text_of`` takes a text out of ``text``.
    """
    languages = list(model.languages)
    kept = [field for field in rows.schema.fields if field.name != "text"]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)

    def scored(batch: dict[str, list]) -> dict[str, list]:
        evidence = [text_evidence(model, text_of(text) if text_of else text) for text in batch["text"]]
        return {**batch, "evidence": evidence, "posterior": [
            _softmax(np.array(one)).tolist() if one and max(one) > 0 else [] for one in evidence]}

    scored_rows = written(map_batches(rows, scored, f"{schema}, evidence array<double>, posterior array<double>").withColumns({
        "host": F.coalesce("host", F.lit("")), "site": F.coalesce("site", F.lit("")),
        "suffix": F.coalesce("suffix", F.lit(""))}))
    if not languages:
        return scored_rows.drop("evidence", "posterior").withColumns({
            "text_language": F.lit(UNKNOWN), "language": F.lit(UNKNOWN), "probability": F.lit(0.0)})
    positions = range(len(languages))
    certain = scored_rows.filter(F.size("posterior") > 0)
    sums = [F.sum(F.element_at("posterior", i + 1)).alias(f"n{i}") for i in positions]
    up = [F.sum(f"n{i}").alias(f"n{i}") for i in positions]
    as_list = F.array(*[f"n{i}" for i in positions])
    hosts = materialise(certain.groupBy("host", "site", "suffix").agg(*sums))
    sites = materialise(hosts.groupBy("site", "suffix").agg(*up))
    suffixes = materialise(sites.groupBy("suffix").agg(*up))
    overall = suffixes.agg(*up).first()
    base = _normalised([(overall[f"n{i}"] or 0.0) + 1 for i in positions])
    # Each level: what it counted, and a prior borrowed from the level above.
    suffix_priors = suffixes.select("suffix", _blend(as_list, F.array(*map(F.lit, base))).alias("above"))
    site_priors = join_lookup(sites, materialise(suffix_priors), "suffix").select(
        "site", "suffix", _blend(as_list, F.col("above")).alias("above"))
    host_priors = join_lookup(hosts, materialise(site_priors), ["site", "suffix"]).select(
        "host", "site", "suffix", as_list.alias("counts"), "above")
    trust = _declared_trust(certain, languages)
    joined = join_lookup(scored_rows, materialise(host_priors), ["host", "site", "suffix"], "left")

    def fused(batch: dict[str, list]) -> dict[str, list]:
        out = {"text_language": [], "language": [], "probability": []}
        for evidence, own, declared, counts, above in zip(
                *[batch[name] for name in ("evidence", "posterior", "declared", "counts", "above")], strict=True):
            best, language, probability = UNKNOWN, UNKNOWN, 0.0
            if own:
                rest = np.maximum(np.array(counts) - own, 0)
                prior = (rest + HOST_WEIGHT * np.array(above)) / (rest.sum() + HOST_WEIGHT)
                belief = np.array(evidence) + np.log(prior)
                if declared is not None:
                    belief = belief + trust[_declared_index(declared, languages)]
                posterior = _softmax(belief)
                best, probability = languages[int(np.argmax(own))], float(posterior.max())
                if probability >= LEAST_PROBABILITY:
                    language = languages[int(posterior.argmax())]
            for name, value in zip(out, (best, language, probability), strict=True):
                out[name].append(value)
        return {**batch, **out}

    return map_batches(joined, fused, f"{schema}, text_language string, language string, probability double")


def _normalised(counts: list[float]) -> list[float]:
    return [n / sum(counts) for n in counts]


def _blend(counts: Column, above: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
    return F.zip_with(counts, above, lambda n, p: (n + HOST_WEIGHT * p) / (total + HOST_WEIGHT))


def _declared_index(declared: str, languages: list[str]) -> int:
    """Where a declaration such as ``en-GB`` stands; all others together come last."""
    primary = declared.strip().lower().replace("_", "-").split("-")[0]
    return languages.index(primary) if primary in languages else len(languages)


def _declared_trust(certain: DataFrame, languages: list[str]) -> np.ndarray:
    """Log probabilities of a declaration (row) given the language (column)."""
    primary = F.split(F.replace(F.lower(F.trim("declared")), F.lit("_"), F.lit("-")), "-")[0]
    known = F.when(primary.isin(languages), primary).otherwise("")
    sums = [F.sum(F.element_at("posterior", i + 1)).alias(f"n{i}") for i in range(len(languages))]
    counts = np.zeros((len(languages) + 1, len(languages)))
    for row in certain.filter("declared is not null").groupBy(known.alias("said")).agg(*sums).collect():
        at = languages.index(row["said"]) if row["said"] in languages else len(languages)
        counts[at] = [row[f"n{i}"] for i in range(len(languages))]
    spread = DECLARED_WEIGHT / (len(languages) + 1)
    return np.log((counts + spread) / (counts.sum(0) + DECLARED_WEIGHT))


def site_of(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def page_text(page: str | None) -> str:
    found = blocks(page or "")
    best = max((zone for zone, _ in found), default=OPEN)
    return " ".join(text for zone, text in found if zone == (ARTICLE if best == ARTICLE else OPEN))


def declared_language(page: Column) -> Column:
    """The ``lang`` of the page's ``html`` element; null without one."""
    found = F.regexp_extract(page, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z][A-Za-z0-9_-]*)""", 1)
    return F.when(found != "", found)


def page_languages(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, url, declared, text_language, language, probability) for each of ``pages`` (page_id, url, html)."""
    host = host_of(F.col("url"))
    rows = pages.select("page_id", "url", F.col("html").alias("text"), declared_language(F.col("html")).alias("declared"),
                        host.alias("host"), site_of(host).alias("site"), F.substring_index(host, ".", -1).alias("suffix"))
    return identify(rows, model, page_text).drop("host", "site", "suffix")


def document_languages(docs: DataFrame, model: TextModel, key: str = "doc_id") -> DataFrame:
    """(``key``, declared, text_language, language, probability) for each of ``docs`` (``key``, text, lang, source).

    The source stands for the host; documents have no address.
    """
    none = F.lit(None).cast("string")
    rows = docs.select(key, "text", F.col("lang").cast("string").alias("declared"), F.col("source").cast("string").alias("host"),
                       none.alias("site"), none.alias("suffix"))
    return identify(rows, model).drop("host", "site", "suffix")


def keep_identified(docs: DataFrame, model: TextModel) -> DataFrame:
    """The rows of ``docs`` whose language is known. Rows of equal doc_id, text, lang and source share a decision."""
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("\u0000")) for name in ("doc_id", "lang", "source")],
                            F.xxhash64("text").cast("string")))
    keyed = docs.withColumn("__key", key)
    unknown = materialise(document_languages(keyed, model, "__key").filter(F.col("language") == UNKNOWN).select("__key").distinct())
    return join_lookup(keyed, unknown, "__key", "left_anti").drop("__key")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "pages"), train(table(spark, sf_dir, "documents")))
