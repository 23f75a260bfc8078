"""Operator 11: fill-in-the-middle texts, cut at line ends that are found in a compressed set of boundaries."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import map_batches, table

# Fixed values of the contract: marks of the parts, seed, and shares in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 7, 100, 50

CHUNK = 1 << 16      # values of a container share all but their low 16 bits
ARRAY_LIMIT = 4096   # values from which on a bitmap is smaller than an array
_WORD_BITS = 64


@dataclass(frozen=True)
class Container:
    """The values of one chunk in the smallest of three forms: sorted ``array``, ``bitmap`` of 64-bit words, ``run``.

    ``counts`` are the cumulative cardinalities within the container: per word of a bitmap, per run of runs.
    """

    kind: str
    values: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> Container:
        """``low``: sorted distinct values below ``CHUNK``, at least one."""
        breaks = np.flatnonzero(np.diff(low) != 1) + 1
        starts = np.concatenate([[0], breaks])
        if 4 * len(starts) < min(2 * len(low), CHUNK // 8):
            lengths = np.diff(np.concatenate([starts, [len(low)]]))
            return cls("run", low[starts].astype(np.uint16), np.cumsum(lengths))
        if len(low) <= ARRAY_LIMIT:
            return cls("array", low.astype(np.uint16), np.zeros(0, np.int64))
        words = np.zeros(CHUNK // _WORD_BITS, np.uint64)
        np.bitwise_or.at(words, low // _WORD_BITS, np.uint64(1) << (low % _WORD_BITS).astype(np.uint64))
        return cls("bitmap", words, np.cumsum(np.bitwise_count(words).astype(np.int64)))

    def select(self, rank: int) -> int:
        """The value of rank ``rank``, from 0."""
        if self.kind == "array":
            return int(self.values[rank])
        at = int(np.searchsorted(self.counts, rank, side="right"))
        before = int(self.counts[at - 1]) if at else 0
        if self.kind == "run":
            return int(self.values[at]) + rank - before
        word = int(self.values[at])
        for _ in range(rank - before):
            word &= word - 1
        return at * _WORD_BITS + (word & -word).bit_length() - 1


@dataclass(frozen=True)
class BoundarySet:
    """A sorted set of offsets: one container per chunk that has any, and the cumulative cardinalities of them."""

    keys: np.ndarray
    containers: list[Container]
    counts: np.ndarray

    @classmethod
    def of(cls, offsets: np.ndarray) -> BoundarySet:
        high = offsets // CHUNK
        starts = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1]) if len(offsets) else np.zeros(0, np.int64)
        ends = np.concatenate([starts[1:], [len(offsets)]]) if len(offsets) else starts
        return cls(
            high[starts], [Container.of(offsets[a:b] % CHUNK) for a, b in zip(starts, ends, strict=True)], ends)

    def __len__(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    def select(self, rank: int) -> int:
        """The offset of rank ``rank``, from 0: the container is searched for, then asked."""
        at = int(np.searchsorted(self.counts, rank, side="right"))
        before = int(self.counts[at - 1]) if at else 0
        return int(self.keys[at]) * CHUNK + self.containers[at].select(rank - before)


def line_ends(text: str) -> BoundarySet:
    """The ends, in code points, of the lines of ``text``; each takes its ``\\n``, the last may lack it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(points == 10) + 1
    if len(points) and points[-1] != 10:
        ends = np.append(ends, len(points))
    return BoundarySet.of(ends)


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[at:at + 8], 16) for at in range(0, 32, 8))


def _cut(batch: dict[str, list], seed: int, fim_percent: int, spm_percent: int) -> dict[str, list]:
    out: dict[str, list] = {name: [] for name in ("__n", "__form", "__prefix_chars", "__middle_chars", "__output")}
    for doc_id, text in zip(batch["__id"], batch["__text"], strict=True):
        text = text or ""
        ends = line_ends(text)
        n = len(ends)
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
            found = (n, "plain", None, None, text)
        else:
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            a, b = (ends.select(cut - 1) if cut else 0 for cut in (first, second))
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if h4 % 100 < spm_percent:
                form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
            else:
                form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
            found = (n, form, a, b - a, output)
        for name, value in zip(out, found, strict=True):
            out[name].append(value)
    return out


def fill_in_middle(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED,
    fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of ``docs``, in no shuffle.

    ``n`` counts the lines; ``output`` is the text in the form ``plain``, ``psm`` or ``spm``. The cuts are drawn from
    ``seed`` and the row's id. A null text is an empty one, whose form is plain, as is that of a text that holds one
    of the marks; then both lengths are null. A null id draws as an empty one. Equal rows come out equal, as often
    as they are; texts of any length are cut whole; columns other than the two are not read, whatever their
    names. No rows: no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    # Columns of the row go by position, so that none of theirs can clash.
    rows = docs.select(F.col(f"`{doc_id}`").alias("__doc_id"), F.col(f"`{doc_id}`").cast("string").alias("__id"),
                       F.col(f"`{text}`").alias("__text"))

    def cut(batch: dict[str, list]) -> dict[str, list]:
        return {"__doc_id": batch["__doc_id"], **_cut(batch, seed, fim_percent, spm_percent)}

    found = map_batches(
        rows, cut, f"__doc_id {kind}, __n long, __form string, __prefix_chars long, __middle_chars long, __output string")
    return found.toDF("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from.

    No mark stands in the text, and none can arise where a part meets a mark, as a mark begins with its only ``<``.
    """
    first = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    rest = F.substr(output, F.lit(len(PREFIX) + 1))
    at, last = F.instr(rest, first), F.instr(rest, F.lit(MIDDLE))
    one = F.substr(rest, F.lit(1), at - 1)
    two = F.substr(rest, at + len(PREFIX), last - at - len(PREFIX))
    middle = F.substr(rest, last + len(MIDDLE))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_GROUPS = ", ".join(
    "(" + " + ".join(f"(strpos('0123456789abcdef', substr(h, {8 * g + i + 1}, 1)) - 1)::BIGINT * {16 ** (7 - i)}" for i in range(8))
    + f") AS h{g + 1}" for g in range(4))
_MARKED = " OR ".join(f"contains(t, '{mark}')" for mark in (PREFIX, SUFFIX, MIDDLE))
# The first lines of a text, by the pieces between its line ends; all of them are the text itself.
_PREFIX_OF = "CASE WHEN {0} = 0 THEN '' WHEN {0} = n THEN t ELSE array_to_string(list_slice(pieces, 1, {0}), chr(10)) || chr(10) END"

OP11_SQL = f"""
    WITH given AS (
        SELECT doc_id, coalesce(text, '') AS t,
               sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    counted AS (
        SELECT doc_id, t, string_split(t, chr(10)) AS pieces, {_GROUPS},
               (length(t) - length(replace(t, chr(10), ''))
               + CASE WHEN t = '' OR right(t, 1) = chr(10) THEN 0 ELSE 1 END)::BIGINT AS n
        FROM given),
    drawn AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR {_MARKED} OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
                    WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
        FROM counted),
    cut AS (
        SELECT *, length({_PREFIX_OF.format('a')})::BIGINT AS x, length({_PREFIX_OF.format('b')})::BIGINT AS y FROM drawn),
    parts AS (
        SELECT *, substr(t, 1, x) AS p, substr(t, x + 1, y - x) AS m, substr(t, y + 1) AS s FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                  ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts"""
