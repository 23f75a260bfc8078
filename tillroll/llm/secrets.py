"""Operator 9: secret scans, with corpus-wide ownership to tell live credentials from copied examples."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import map_batches, table
from tillroll.scratch import materialise

# Fixed values of the query: the base patterns, in their order, and the least length of what they find.
BASE = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# What the method looks at beyond them: (kind, pattern, group of the credential). Fixed values.
WIDER = (
    ("key", re.compile(
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:\s*[A-Za-z-]++:[^\n]*\n)*+[A-Za-z0-9+/=\s]{32,}"
        r"(?:-----END [A-Z ]*PRIVATE KEY-----)?"), 0),
    ("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0),
    ("prefixed", re.compile(r"\b(?:gh[pousr]_|xox[abpr]-|sk_live_|sk-|AIza)[A-Za-z0-9_-]{16,}"), 0),
    ("bearer", re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,})"), 1),
    ("url", re.compile(r"://[^\s:/@]++:([^\s:/@]{8,}+)@"), 1),  # from "://", the scheme is looked for backwards
)
WIDER_SIGNS = (b"-----BEGIN", b"eyJ", b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_", b"xox", b"sk_live_", b"sk-", b"AIza",
               b"earer ", b"://")
KINDS = [kind for kind, *_ in BASE] + [kind for kind, *_ in WIDER]

SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")

MOST_OWNERS = 2      # a credential of more owners is a copied example,
OWNER_SHARE = 0.9    # unless one of them has at least this share of the repositories that hold it
LEAST_ENTROPY = 3.0  # bits per character of one that looks live

CANDIDATE = "array<struct<kind: string, start: long, end: long, hash: string, lively: boolean>>"


def entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def candidates(text: str) -> tuple[list[tuple], list[tuple]]:
    """(kind, start, end, hash, lively) of the base findings and of the wider ones.

    A wider finding may overlap base ones, but one within a single base finding says nothing new and is left out, as is
    one that overlaps a wider finding of a kind listed before. Places are code points, ``end`` exclusive; the hash is
    of the credential itself. No finding has a greatest length.
    """
    data = text.encode("utf-8", "surrogatepass")
    base, wider = [], []
    low = data.lower()
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not any(word in low for word in ASSIGN_WORDS) or kind == "access" and b"AKIA" not in data:
            continue
        for match in pattern.finditer(text):
            if len(match[group]) >= least:
                base.append(_candidate(kind, match.start(), match.end(), match[group]))
    if any(sign in data for sign in WIDER_SIGNS):
        spans = sorted((start, end) for _, start, end, _, _ in base)
        starts, furthest = [start for start, _ in spans], list(accumulate((end for _, end in spans), max))
        taken: list[tuple[int, int]] = []
        for kind, pattern, group in WIDER:
            own = []
            for match in pattern.finditer(text):
                start = match.start() if kind != "url" else scheme_start(text, match.start())
                if start is None:
                    continue
                before = bisect_right(starts, start)
                if before and furthest[before - 1] >= match.end():
                    continue
                at = bisect_right(taken, (start, len(text)))
                if (not at or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= match.end()):
                    own.append((start, match.end()))
                    wider.append(_candidate(kind, start, match.end(), match[group]))
            taken = sorted(taken + own)
    return base, wider


def scheme_start(text: str, at: int) -> int | None:
    """Where the scheme that ends at ``at`` starts: a letter and one more character at least, else None."""
    start = at
    while start and text[start - 1] in SCHEME:
        start -= 1
    while start < at and not "a" <= text[start] <= "z":
        start += 1
    return start if at - start >= 2 else None


def _candidate(kind: str, start: int, end: int, value: str) -> tuple:
    digest = hashlib.md5(value.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()
    return kind, start, end, digest, entropy(value) >= LEAST_ENTROPY


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start, then kind as listed."""
    placed = F.transform(spans, lambda s: F.struct(
        s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["end"], s["kind"]))
    return F.array_join(F.transform(F.array_sort(placed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, plus ``base`` and ``wider`` candidates. Null texts are empty; no shuffle."""
    kept = [field for field in docs.schema.fields if field.name != "text"]

    def scanned(batch: dict[str, list]) -> dict[str, list]:
        found = [candidates(text or "") for text in batch["text"]]
        names = ("kind", "start", "end", "hash", "lively")
        spans = [[[dict(zip(names, one, strict=True)) for one in row[part]] for row in found] for part in (0, 1)]
        return {**batch, "base": spans[0], "wider": spans[1]}

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    return map_batches(docs, scanned, f"{schema}, base {CANDIDATE}, wider {CANDIDATE}")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories, most) over ``found`` (owner, repository, base, wider), a row per credential.

    ``repositories`` counts the different texts of each owner that hold it, so exact copies count once; ``most`` is the
    greatest such number of one owner. Rows are made distinct before they are counted, and counted by owner first,
    so no task gathers the copies of a common credential.
    """
    every = found.select("owner", "repository", F.explode(F.concat("base", "wider")).alias("c")).select(
        F.col("c.hash").alias("hash"), F.struct("owner").alias("owner"), "repository")
    by_owner = every.distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"), F.max("n").alias("most"))


def owner_specific() -> Column:
    """Whether a credential belongs to its owners instead of being copied widely, by the columns of ``ownership``."""
    return (F.col("owners") <= MOST_OWNERS) | (F.col("most") >= OWNER_SHARE * F.col("repositories"))


def find_secrets(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Secrets in each row of ``docs`` (doc_id, text, and the column that names the owner).

    Gives doc_id, row_key, n_assign, n_access, n_hex, base_sha256, n_live, n_examples, spans (text) and live (array).
    ``spans`` holds all base findings, and of the wider ones those whose credential looks live; ``live`` the places of all
    that look live, base or wider: enough entropy, and owner-specific in the whole corpus. A repository is a different text
    of an owner. A credential of at most ``MOST_OWNERS`` owners is theirs, in however many repositories they repeat it; one
    of more is a copied example, unless a single owner has ``OWNER_SHARE`` of the repositories and the others are strays.
    A null owner counts as one. Null and empty texts have no secrets. Equal rows get equal results. No rows: no rows.
    """
    prepared = docs.select(
        "doc_id", F.col(owner).alias("owner"), F.xxhash64("text").alias("repository"), row_key().alias("row_key"), "text")
    found = materialise(scan(prepared).withColumn("row", F.monotonically_increasing_id()))
    verdicts = materialise(ownership(found).select("hash", owner_specific().alias("own")))
    each = found.filter(F.size("base") + F.size("wider") > 0).select(
        "row", F.posexplode(F.concat("base", "wider")).alias("position", "c"), F.size("base").alias("bases"))
    judged = each.withColumn("hash", F.col("c.hash")).join(verdicts.hint("merge"), "hash").select(
        "row", (F.col("own") & F.col("c.lively")).alias("live"), (F.col("position") < F.col("bases")).alias("is_base"), "c")
    by_row = judged.groupBy("row").agg(
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_examples"),
        F.collect_list(F.when(F.col("live"), F.struct(F.col("c.start").alias("start"), F.col("c.end").alias("end")))).alias("live"),
        F.collect_list(F.when(F.col("live") & ~F.col("is_base"), F.col("c"))).alias("added"))
    joined = found.join(by_row, "row", "left")
    base = lambda kind: F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long")
    reported = F.concat("base", F.coalesce("added", F.array().cast(CANDIDATE)))
    return joined.select(
        "doc_id", "row_key", base("assign").alias("n_assign"), base("access").alias("n_access"), base("hex").alias("n_hex"),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(reported).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
        F.coalesce("live", F.array().cast("array<struct<start: long, end: long>>")).alias("live"))


def row_key() -> Column:
    """A hash of doc_id and text: rows that agree in both have the same secrets."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("\u0000")), F.xxhash64("text").cast("string")))


def redact(docs: DataFrame, mark: str = "[SECRET]", owner: str = "source") -> DataFrame:
    """``docs`` with every finding of ``find_secrets`` that looks live replaced by ``mark`` and ``n_chars`` to match.

    Copied examples and dull texts such as a repeated letter stay. All rows stay. Overlapping findings are replaced as one.
    """
    places = find_secrets(docs, owner).filter(F.size("live") > 0).select(
        F.col("row_key").alias("__row"), F.col("live").alias("__places")).dropDuplicates(["__row", "__places"])
    joined = docs.withColumn("__row", row_key()).join(materialise(places).hint("merge"), "__row", "left")
    hit = F.col("__places").isNotNull()

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        def cut(text, spans):
            parts, at = [], 0
            for start, end in spans:
                if start >= at:
                    parts += [text[at:start], mark]
                at = max(at, end)
            return "".join([*parts, text[at:]])

        return pd.Series([
            None if text is None else cut(text, sorted(zip(first, last, strict=True)))
            for text, first, last in zip(texts, starts, ends, strict=True)], dtype=object)

    # Only texts with a span go through Python.
    text = replaced(F.when(hit, F.col("text")), F.col("__places.start"), F.col("__places.end"))
    result = joined.withColumn("text", F.coalesce(text, "text"))
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.when(
            hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return result.select(*docs.columns)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("row_key", "live")
