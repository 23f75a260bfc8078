"""Operator 12: the cheapest repair of a conversation's turns, by branch and bound.

A conversation is a sequence of rows ordered by turn. Its roles have to read ``(s?(ua)+)?``; rows are kept, given
the other role, deleted, and turns without text are inserted. Rows are repaired segment by segment, so that a task
holds a segment of them and one letter for each earlier row, however long the conversation.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.tables import share_code, table, written

# Fixed values of the contract: what the edits cost, and what ends a whole turn.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
SEGMENT = 256  # rows that are repaired at once
OUT_ROWS = 4_096

# What was emitted last: nothing, a system turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NORMAL, BROKEN, UNUSABLE = range(3)  # a row as it is, a truncated one, one that has to go


def _next_role(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _bounds(rows: list[tuple[str, int]]) -> list[tuple[int, int]]:
    """For each row on: the least that the rest costs where a user's (0) or an assistant's turn (1) is due.

    A relaxation: the rest may end anywhere, and system turns may stand wherever a user's is due.
    """
    bounds = [(0, 0)] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        initial, state = rows[i]
        due = []
        for expected in (0, 1):
            best = DELETE + bounds[i + 1][expected]
            if state != UNUSABLE:
                extra = TRUNCATED if state == BROKEN else 0
                best = min(best, REROLE + extra + bounds[i + 1][1 - expected])
                if initial == "ua"[expected]:
                    best = min(best, extra + bounds[i + 1][1 - expected])
                elif initial == "s" and not expected:
                    best = min(best, extra + bounds[i + 1][0])
            due.append(best)
        bounds[i] = (min(due[0], due[1] + INSERT), min(due[1], due[0] + INSERT))
    return bounds


def _moves(i: int, state: int, rows: list[tuple[str, int]], last: bool) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, next row, next state) of every edit."""
    if i < len(rows):
        initial, kind = rows[i]
        yield "D", DELETE, i + 1, state
        if kind != UNUSABLE:
            extra = TRUNCATED if kind == BROKEN else 0
            kept = _KEEPS.get((state, initial))
            if kept is not None:
                yield "K", extra, i + 1, kept
            yield "R", REROLE + extra, i + 1, _next_role(state)
    # After the rows of a segment that is not the last, turns are inserted before the next segment's first row.
    if i < len(rows) or last:
        yield "I", INSERT, i, _next_role(state)


def cheapest(rows: list[tuple[str, int]], entry: int, goals: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """The least (cost, letters) that leads from ``entry`` over all ``rows`` to one of ``goals``; None if none does.

    Depth first with a stack of open prefixes, the most promising on top. A prefix goes where its cost and the bound
    of the rest exceed the best solution so far, or equal it with later letters, and where another prefix reached
    the same row and state for less, or for the same by earlier letters: no two prefixes of one cost there are the
    beginnings of one another, as they differ by an insertion only, which costs. What the stack leaves is proved best.
    """
    bounds = _bounds(rows)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, letters, i, state = stack.pop()
        known = reached.get((i, state))
        if known is not None and known <= (cost, letters):
            continue
        if best is not None:
            least = cost + bounds[i][state == USER]
            if least > best[0] or least == best[0] and letters > best[1][:len(letters)]:
                continue
        reached[i, state] = (cost, letters)
        if i == len(rows) and state in goals and (best is None or (cost, letters) < best):
            best = (cost, letters)
        moves = [(cost + price + bounds[j][to == USER], letters + letter, cost + price, j, to)
                 for letter, price, j, to in _moves(i, state, rows, last)]
        moves.sort(reverse=True)
        stack.extend((price, text, j, to) for _, text, price, j, to in moves)
    return best


class _Path:
    """The cheapest repairs of the rows so far, one for each state that they can end in."""

    def __init__(self) -> None:
        self.ends = {START: (0, 0, None)}  # state: (cost, rank of the letters, (earlier, letters))
        self.rows: list[tuple[str, int]] = []

    def add(self, row: tuple[str, int]) -> bool:
        """Take a row; whether this completed a segment."""
        self.rows.append(row)
        if len(self.rows) < SEGMENT:
            return False
        self._close(False)
        return True

    def _close(self, last: bool) -> None:
        found: dict[int, tuple] = {}
        for goal in _ENDS if last else range(4):
            for entry, (cost, rank, path) in self.ends.items():
                part = cheapest(self.rows, entry, (goal,), last)
                if part is None:
                    continue
                # Letters of different earlier ends differ before either is over, so their rank decides.
                key = (cost + part[0], rank, part[1])
                if goal not in found or key < found[goal][0]:
                    found[goal] = (key, (path, part[1]))
        order = sorted(found, key=lambda goal: found[goal][0][1:])
        self.ends = {goal: (found[goal][0][0], order.index(goal), found[goal][1]) for goal in order}
        self.rows = []

    def finish(self) -> tuple[int, list[str]]:
        """The cost, and the letters of each segment."""
        self._close(True)
        cost, _, path = min(self.ends.values(), key=lambda end: end[:2])
        parts: list[str] = []
        while path is not None:
            path, letters = path
            parts.append(letters)
        return cost, parts[::-1]


def repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost and the letters of the edits (ASCII-least among equals) of rows (initial, kind)."""
    path = _Path()
    for row in rows:
        path.add(row)
    cost, parts = path.finish()
    return cost, "".join(parts)


def shown(text: str) -> Column:
    """A column as text, a null as one space."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as the contract damages them; ``times`` is 2 for a row that is repeated.

    A null conv_id or turn counts as a space in what is hashed, a null role or text is a space.
    """
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(shown("text"), STOPS, "")).otherwise(shown("text"))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("times")).filter(fault != 0)


def _order(rows: DataFrame) -> DataFrame:
    """Rows of a conversation, which share a task, in order; rows of one turn by role and a hash of their text."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text_id", "kind", "part"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


_STEP = ("conv_id {id}, turn {turn}, role string, text_id binary, kind int, part int, letters string, cost long, "
         "blank long, duplicate long, truncated long, illegal long, gaps long")
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in order to letters: a row of ``kind`` 0 per segment, with the place of its first row, and one of kind 1
    for the whole conversation."""
    out: list[tuple] = []
    conversation, path, before = None, None, None
    places: list[tuple] = []
    counts, turns, first, latest = {}, 0, None, None

    def end() -> None:
        cost, parts = path.finish()
        gaps = latest - first + 1 - turns if turns else 0
        # A conversation whose rows fill whole segments ends with one of none, which may insert a turn.
        places.extend(places[-1:] * (len(parts) - len(places)))
        for number, (place, part) in enumerate(zip(places, parts, strict=True)):
            out.append((conversation[0], *place, 0, number, part, *[None] * 6))
        out.append((conversation[0], None, None, None, 1, None, None, cost, *[counts[name] for name in _COUNTS], gaps))

    def taken() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(names.index(name)).to_pylist() for name in (
            "conv_id", "turn", "role", "text_id", "initial", "is_blank", "is_seen", "is_truncated", "copies")]
        for conv_id, turn, role, text_id, initial, is_blank, is_seen, is_truncated, copies in zip(*columns, strict=True):
            if conversation is None or conversation[0] != conv_id:
                if conversation is not None:
                    end()
                    if len(out) >= OUT_ROWS:
                        yield taken()
                conversation, path, before, places = (conv_id,), _Path(), None, []
                counts, turns, first, latest = dict.fromkeys(_COUNTS, 0), 0, None, None
            if turn is not None:
                first = turn if first is None else first
                turns += turn != latest
                latest = turn
            starts = not path.rows
            for copy in range(copies):
                duplicate = is_seen or copy > 0
                if is_blank:
                    fault = "blank"
                elif duplicate:
                    fault = "duplicate"
                else:
                    fault = "truncated" if is_truncated else None
                if fault:
                    counts[fault] += 1
                counts["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
                before = initial
                if starts:
                    places.append((turn, role, text_id))
                kind = UNUSABLE if is_blank or duplicate else BROKEN if is_truncated else NORMAL
                starts = path.add((initial, kind))
    if conversation is not None:
        end()
    if out:
        yield taken()


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Letters and texts in order to the hash of the repaired conversation; a text at a time."""
    ids: list = []
    hashes: list[str] = []
    conversation, digest, letters, state, lines = None, None, deque(), START, 0

    def line(role: str, text: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        lines += 1

    def edits() -> Iterator[str]:
        """The next letters up to one that is not an insertion, those carried out."""
        nonlocal state
        while letters:
            letter = letters.popleft()
            if letter != "I":
                yield letter
                continue
            state = _next_role(state)
            line(("user", "assistant")[state == ASSISTANT], "")

    def end() -> None:
        for letter in edits():
            raise AssertionError(f"an edit {letter} without a row")
        ids.append(conversation[0])
        hashes.append(digest.hexdigest())

    def taken() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(ids, schema.field(0).type), pa.array(hashes, pa.string())], schema=schema)
        ids.clear(), hashes.clear()
        return found

    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(names.index(name)).to_pylist() for name in (
            "conv_id", "kind", "letters", "role", "text", "times")]
        for conv_id, kind, more, role, text, times in zip(*columns, strict=True):
            if conversation is None or conversation[0] != conv_id:
                if conversation is not None:
                    end()
                    if len(ids) >= OUT_ROWS:
                        yield taken()
                conversation, digest, letters, state, lines = (conv_id,), hashlib.sha256(), deque(), START, 0
            if kind == 0:
                letters.extend(more)
                continue
            for _ in range(times):
                letter = next(edits())
                if letter == "K":
                    state = _KEEPS[state, role[:1]]
                    line(role, text)
                elif letter == "R":
                    state = _next_role(state)
                    line(("user", "assistant")[state == ASSISTANT], text)
    if conversation is not None:
        end()
    if ids:
        yield taken()


def _in_order(rows: DataFrame, step, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    share_code(rows.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))
    return _order(rows).mapInArrow(lambda batches: step(batches, target), schema)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``rows``: conv_id, turn, role, text, and how many ``times`` each row stands there; other columns are not read.
    A conversation's rows go by turn (nulls first), those of one turn by role and a hash of the text, equal rows one
    after the other. A role or text that is null is one space. A null conv_id is a conversation too. No rows: no rows.

    Equal rows are counted before they are moved, and which texts were seen earlier is found by grouping, so
    neither a row that is repeated very often nor a very long conversation has to be held by a task. One task
    does read the rows of a conversation in order, without their texts, and keeps a letter for each; another
    reads the texts, as their hash can only be worked out from first to last.
    """
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("conv_id", "turn")}
    if not isinstance(rows.schema["turn"].dataType, T.IntegralType):
        raise ValueError("turns must be whole numbers")
    role, text = shown("role"), shown("text")
    core = F.rtrim(text, F.lit(BLANKS))
    named = rows.select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.md5(text)).alias("text_id"), "times",
        (core == "").alias("is_blank"), (~F.right(core, F.lit(1)).isin(*STOPS)).alias("is_truncated"))
    key = ["conv_id", "turn", "role", "text_id"]
    found = named.groupBy(*key).agg(
        F.sum("times").cast("long").alias("copies"), F.first("is_blank").alias("is_blank"),
        F.first("is_truncated").alias("is_truncated"))
    # Nulls come first, so a text of the null turn is earlier than all.
    place = F.struct(F.col("turn").isNotNull(), "turn")
    earliest = found.groupBy("conv_id", "role", "text_id").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("places"))
    repeated = earliest.filter("places > 1").select(
        F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("text_id").alias("__text"), "earliest")
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("text_id") == F.col("__text"))
    slim = found.join(repeated, same, "left").select(
        *key, F.lit(1).alias("kind"), F.lit(0).alias("part"), F.substring("role", 1, 1).alias("initial"), "is_blank", "is_truncated", "copies",
        (F.col("earliest").isNotNull() & ~place.eqNullSafe(F.col("earliest"))).alias("is_seen"))
    steps = written(_in_order(slim, _repaired, _STEP.format(id=kinds["conv_id"], turn=kinds["turn"])))

    whole = steps.filter("kind = 1").select("conv_id", "gaps", *_COUNTS, "cost")
    segments = steps.filter("kind = 0")
    texts = rows.select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.md5(text)).alias("text_id"), F.lit(1).alias("kind"), F.lit(0).alias("part"),
        F.lit(None).cast("string").alias("letters"), text.alias("text"), "times")
    letters = segments.select(*key, "kind", "part", "letters", F.lit("").alias("text"), F.lit(0).alias("times"))
    hashes = _in_order(letters.unionByName(texts), _hashed, f"conv_id {kinds['conv_id']}, repaired_sha256 string")
    # The letters of a conversation, as long as it has rows, make up one value of the result.
    audits = segments.groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "letters"))), lambda part: part["letters"]), "").alias("audit"))
    return (
        _joined(_joined(whole, audits), hashes)
        .select("conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"))


def _joined(one: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    named = other.withColumnRenamed("conv_id", "__conv")
    return one.join(named, F.col("conv_id").eqNullSafe(F.col("__conv")), how).drop("__conv")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = repair_conversations(damaged(given))
    none = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("long")
    return _joined(given.select("conv_id").distinct(), found, "left").select(
        "conv_id", *[F.coalesce(name, zero).alias(name) for name in ("gaps", *_COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def _best(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def _move(state: str, letter: str, cost: str, line: str | None = None, when: str = "true") -> str:
    """A state's (cost, audit, lines) after an edit; null where the state is not reached or the edit not allowed."""
    text = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _inserted(columns: str, source: str) -> str:
    """The states after any insertions; more than two in a row never pay."""
    return f"""
        SELECT {columns}, n, s, u, {_best('a', _move('u', 'I', '5', "'assistant:'"))} AS a
        FROM (SELECT {columns}, n, s, a, {_best('u', *[_move(x, 'I', '5', "'user:'") for x in 'nsa'])} AS u FROM {source})"""


_ROW_COST = "CASE WHEN kind = 'truncated' THEN 5 ELSE 0 END"
_USABLE = "kind NOT IN ('blank', 'duplicate')"
_LINE = "role || ':' || text"
_EDITS = {
    "n": [_move("n", "D", "2")],
    "s": [_move("s", "D", "2"), _move("n", "K", _ROW_COST, _LINE, f"{_USABLE} AND i = 's'")],
    "u": [_move("u", "D", "2"), *[m for x in "nsa" for m in (
        _move(x, "K", _ROW_COST, _LINE, f"{_USABLE} AND i = 'u'"),
        _move(x, "R", f"1 + {_ROW_COST}", "'user:' || text", _USABLE))]],
    "a": [_move("a", "D", "2"), _move("u", "K", _ROW_COST, _LINE, f"{_USABLE} AND i = 'a'"),
          _move("u", "R", f"1 + {_ROW_COST}", "'assistant:' || text", _USABLE)],
}

# ``crc32`` as SQL: eight steps for each of the few characters of a key, all of them ASCII.
_CRC = ("list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(k) + 1), lambda j: unicode(substr(k, j, 1))::UBIGINT)), "
        "lambda h, b: list_reduce(list_prepend(xor(h, b), list_transform(range(8), lambda j: 0::UBIGINT)), "
        "lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))")
_CORE = "rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP12_SQL = f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
        FROM conversations),
    faults AS (SELECT *, xor({_CRC}, 4294967295::UBIGINT) % 20 AS f FROM keyed),
    damaged AS (
        SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
               CASE f WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
               unnest(CASE f WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM faults WHERE f <> 0),
    numbered AS (
        SELECT *, substr(role, 1, 1) AS i, {_CORE} AS core,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
        FROM damaged),
    judged AS (
        SELECT conv_id, turn, role, text, i, pos,
               CASE WHEN core = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'whole' END AS kind,
               lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i NOT IN ('su', 'ua', 'au') AS wrong
        FROM numbered),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
               count(*) FILTER (kind = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal, max(pos) AS n_rows
        FROM judged GROUP BY conv_id),
    step AS (
        SELECT conv_id, 1::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS n,
               NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS u,
               NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS a
        FROM counted
        UNION ALL
        SELECT conv_id, pos + 1, {_best(*_EDITS['n'])}, {_best(*_EDITS['s'])}, {_best(*_EDITS['u'])}, {_best(*_EDITS['a'])}
        FROM ({_inserted('conv_id, pos, role, text, i, kind', '(SELECT step.*, role, text, i, kind FROM step JOIN judged ON judged.conv_id IS NOT DISTINCT FROM step.conv_id AND judged.pos = step.pos) AS p')}) AS q),
    ended AS (
        SELECT conv_id, pos, {_best('n', 'a')} AS best
        FROM ({_inserted('conv_id, pos', 'step')}) AS q),
    given AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT given.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
           coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
    FROM given LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM given.conv_id
    LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM given.conv_id AND ended.pos = n_rows + 1"""
