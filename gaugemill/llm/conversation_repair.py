"""Repair of the turns of conversations: faults are counted, and the cheapest edits are made.

Turns are taken by ``turn`` (NULL first; of equal ones by role and the text's SHA-256). NULL in
role or text counts as one space, a NULL ``conv_id`` is a conversation of its own. A turn is
``blank`` without a character other than white space, ``duplicate`` if role and text were seen
before in the conversation, or else ``truncated`` if its last such character is not one of
``.!?``. Blank and duplicate turns are deleted; ``turn_edits`` finds the other edits.

Conversations are sorted into tasks and solved there. One that holds more than ``SPLIT_ROWS``
rows or ``SPLIT_BYTES`` of text, or a hundred-thousandth of all if that is more, is split: equal
turns are counted, the others sorted by range into as many tasks as the session deals, and cut
into steps of ``STEP_TURNS``. Each step gives its costs between all pairs of states; these, some
200 bytes a step, meet in one task per conversation, which gives each step its two states.
At most 200,000 conversations are that large, whatever the input, so their ids are broadcast.

An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gaugemill.llm.turn_edits import (
    DELETE,
    START,
    applied,
    code_of,
    crossing_costs,
    crossings,
    edits_of,
    solve,
)

SPLIT_ROWS = 1_000
SPLIT_BYTES = 64 << 20
SPLIT_SHARE = 100_000
STEP_TURNS = 4_096
SALTS = 16
BATCH_CHARS = 4 << 20

_SPACES = "\x20\x09-\x0D"
_TURNS = "array<struct<role: string, text: string>>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


@dataclass(frozen=True)
class Repaired:
    """Counts, the edits' initials (``audit``) and the repaired turns of all conversations.

    ``whole`` has a row with all of it per conversation. Of the conversations that were split,
    ``audits`` has counts and audit, and ``steps`` the turns, in runs that follow each other by
    ``step``.
    """

    whole: DataFrame
    audits: DataFrame | None = None
    steps: DataFrame | None = None


def repair_conversations(
    rows: DataFrame,
    folder: Callable[[], str],
    split_rows: int = SPLIT_ROWS,
    split_bytes: int = SPLIT_BYTES,
    step_turns: int = STEP_TURNS,
) -> Repaired:
    """Repair the conversations in ``conv_id, turn, role, text``.

    A row with true in a column ``lost``, if there is one, only names its conversation.
    """
    turns = _turns(rows)
    sizes = turns.groupBy("conv_id").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")
    )
    whole = sizes.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    most_rows = max(split_rows, (whole["rows"] or 0) // SPLIT_SHARE)
    most_bytes = max(split_bytes, (whole["bytes"] or 0) // SPLIT_SHARE)
    large = sizes.where((F.col("rows") > most_rows) | (F.col("bytes") > most_bytes))
    ids = large.select(F.col("conv_id").alias("large_id")).collect()  # 2 x SPLIT_SHARE at most
    if not ids:
        return Repaired(_whole(turns))
    schema = T.StructType([T.StructField("large_id", rows.schema["conv_id"].dataType)])
    names = F.broadcast(rows.sparkSession.createDataFrame(ids, schema))
    is_large = turns["conv_id"].eqNullSafe(names["large_id"])
    return Repaired(
        _whole(turns.join(names, is_large, "left_anti")),
        *_split(turns.join(names, is_large, "left_semi"), folder, step_turns),
    )


def _turns(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(" "))
    lost = F.coalesce(F.col("lost"), F.lit(False)) if "lost" in rows.columns else F.lit(False)
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        lost.alias("lost"),
    )


def _is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_SPACES}]")


def _is_truncated(text: Column) -> Column:
    return text.rlike(rf"[^{_SPACES}.!?][{_SPACES}]*\z")


def _kind(turns: DataFrame) -> T.DataType:
    return turns.schema["conv_id"].dataType


# Conversations in one task


def _whole(turns: DataFrame) -> DataFrame:
    kind = _kind(turns)
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    return (
        turns.select(
            "conv_id",
            "turn",
            "role",
            "text",
            "lost",
            "digest",
            _is_blank(F.col("text")).alias("blank"),
            _is_truncated(F.col("text")).alias("truncated"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "digest")
        .drop("digest")
        .mapInArrow(
            _repairer(to_arrow_type(kind)),
            f"conv_id {kind.simpleString()}, {counts}, audit string, turns {_TURNS}",
        )
    )


def _runs(
    batches: Iterator[pa.RecordBatch], most: int | None = None
) -> Iterator[tuple[object, list[list]]]:
    """The rows of each conversation, of input that is sorted by it; ``most`` at a time."""
    held, name = [], None
    for batch in batches:
        for each, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and (each != name or len(held) == most):
                yield name, held
                held = []
            name = each
            held.append(row)
    if held:
        yield name, held


def _repairer(kind: pa.DataType) -> Callable:
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema(
        [
            ("conv_id", kind),
            *((name, pa.int64()) for name in _COUNTS),
            ("audit", pa.string()),
            ("turns", pa.list_(turn)),
        ]
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for name, rows in _runs(batches):
            found.append({"conv_id": name, **_repaired([row for row in rows if not row[3]])})
            size += sum(len(row[2]) for row in rows)
            if size >= BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(found, schema)
                found, size = [], 0
        yield pa.RecordBatch.from_pylist(found, schema)

    return repair


def _repaired(rows: list[list]) -> dict:
    """Counts, audit and repaired turns of one conversation."""
    codes, seen, counts = [], set(), dict.fromkeys(_COUNTS, 0)
    for _, role, text, _, blank, truncated in rows:
        repeated = (role, text) in seen
        fault = "blank" if blank else "duplicate" if repeated else "truncated"
        if blank or repeated or truncated:
            counts[fault] += 1
        seen.add((role, text))
        codes.append(code_of(role, truncated, blank or repeated))
    numbers = {row[0] for row in rows if row[0] is not None}
    if numbers:
        counts["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers)
    counts["illegal"] = illegal_pairs([row[1][:1] for row in rows])
    blocks, after, counts["cost"] = edits_of(codes)
    if after:
        blocks.append("I" * after)
        rows = [*rows, (None, "", None, False, False, False)]
    state, turns = START, []
    for block, row in zip(blocks, rows):
        state, made = applied(state, block, row[1], row[2])
        turns += [{"role": role, "text": text or ""} for role, text in made]
    return counts | {"audit": "".join(blocks), "turns": turns}


def illegal_pairs(initials: list[str]) -> int:
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    return sum(pair not in legal for pair in zip(initials, initials[1:]))


# Conversations over many tasks


def _split(
    turns: DataFrame, folder: Callable[[], str], step_turns: int
) -> tuple[DataFrame, DataFrame]:
    """Without texts until the edits are known: turns are told apart by their digests."""
    spark, kind = turns.sparkSession, _kind(turns)
    names = turns.select(F.col("conv_id").alias("of_conv_id")).distinct()
    turns = turns.where(~F.col("lost"))
    texts = turns.groupBy("conv_id", "digest").agg(F.first("text").alias("text"))
    # Equal turns are one row with their number; all but the first of them are duplicates.
    slim = turns.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("n"),
        F.first(_is_blank(F.col("text"))).alias("blank"),
        F.first(_is_truncated(F.col("text"))).alias("truncated"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    path = folder()
    (
        _flagged(slim)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_stepper(step_turns, to_arrow_type(kind)), _step_schema(kind))
        .write.parquet(path)
    )
    steps = spark.read.parquet(path)
    path = folder()
    (
        steps.select("conv_id", "part", "place", "costs", "first", "last", *_STEP_COUNTS)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "place")
        .mapInArrow(_crosser(to_arrow_type(kind)), _crossing_schema(kind))
        .write.parquet(path)
    )
    ends = spark.read.parquet(path)
    keys = ["conv_id", "part", "place"]
    renamed = ends.select(
        *(F.col(name).alias(f"of_{name}") for name in keys), "step", "begin", "end", "after"
    )
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in keys]
    path = folder()
    (
        steps.join(renamed, same)
        .select("conv_id", "step", "begin", "end", "after", "codes", "extra", "roles", "digests")
        .mapInArrow(
            _solver(to_arrow_type(kind)),
            f"conv_id {kind.simpleString()}, step long, audit string, "
            "turns array<struct<role: string, digest: binary>>",
        )
        .write.parquet(path)
    )
    solved = spark.read.parquet(path)
    numbers = (
        slim.select("conv_id", "turn")
        .distinct()
        .groupBy("conv_id")
        .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    )
    totals = ends.groupBy("conv_id").agg(*(F.max(name).alias(name) for name in _COUNTS[1:]))
    pieces = F.sort_array(F.collect_list(F.struct("step", "audit")))
    audits = solved.groupBy("conv_id").agg(
        F.concat_ws("", F.transform(pieces, _audit)).alias("audit")
    )
    result = names
    for part in (numbers, totals, audits):
        same = F.col("of_conv_id").eqNullSafe(part["conv_id"])
        result = result.join(part, same, "left").drop(part["conv_id"])
    result = result.select(
        F.col("of_conv_id").alias("conv_id"),
        *(F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in _COUNTS),
        F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
    )
    return result, _with_texts(solved, texts)


def _flagged(slim: DataFrame) -> DataFrame:
    """Whether role and text of a turn were seen in an earlier one.

    Only what is repeated is joined, salted by turn: it may be most of a conversation.
    """
    again = ["conv_id", "role", "digest", "salt"]
    repeated = (
        slim.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first_turn"), F.count("*").alias("turns"))
        .where("turns > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        .select(*(F.col(name).alias(f"of_{name}") for name in again), "first_turn")
    )
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in again]
    return (
        slim.withColumn("salt", salt)
        .join(repeated, same, "left")
        .select(
            *slim.columns,
            F.coalesce(F.struct("turn") > F.col("first_turn"), F.lit(False)).alias("duplicate"),
        )
    )


def _audit(entry: Column) -> Column:
    return entry["audit"]


def _with_texts(solved: DataFrame, texts: DataFrame) -> DataFrame:
    """Repaired turns of each step, with the texts that their digests stand for."""
    lines = solved.select("conv_id", "step", F.posexplode("turns").alias("line", "turn"))
    texts = texts.select(
        F.col("conv_id").alias("of_conv_id"), F.col("digest").alias("of_digest"), "text"
    )
    same = [
        F.col("conv_id").eqNullSafe(F.col("of_conv_id")),
        F.col("turn.digest") == F.col("of_digest"),  # none for an inserted turn
    ]
    turn = F.struct(
        "line",
        F.col("turn.role").alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return (
        lines.join(texts, same, "left")
        .groupBy("conv_id", "step")
        .agg(F.sort_array(F.collect_list(turn)).alias("lines"))
        .select(
            "conv_id",
            "step",
            F.transform("lines", lambda x: F.struct(x["role"], x["text"]))
            .cast(_TURNS)
            .alias("turns"),
        )
    )


# Of a step; ``copies`` are turns beyond the first of several equal ones.
_STEP_COUNTS = ("blank", "duplicate", "truncated", "illegal", "copies")


def _step_schema(kind: T.DataType) -> str:
    return (
        f"conv_id {kind.simpleString()}, part int, place int, codes binary, extra array<long>, "
        "roles array<string>, digests array<binary>, costs array<array<long>>, "
        "first string, last string, " + ", ".join(f"{name} long" for name in _STEP_COUNTS)
    )


def _crossing_schema(kind: T.DataType) -> str:
    return (
        f"conv_id {kind.simpleString()}, part int, place int, step long, begin int, end int, "
        "after int, " + ", ".join(f"{name} long" for name in _COUNTS[1:])
    )


def _stepper(step_turns: int, kind: pa.DataType) -> Callable:
    """Sorted turns in runs of so many, with the costs of each."""
    schema = pa.schema(
        [
            ("conv_id", kind),
            ("part", pa.int32()),
            ("place", pa.int32()),
            ("codes", pa.binary()),
            ("extra", pa.list_(pa.int64())),
            ("roles", pa.list_(pa.string())),
            ("digests", pa.list_(pa.binary())),
            ("costs", pa.list_(pa.list_(pa.int64()))),
            ("first", pa.string()),
            ("last", pa.string()),
            *((name, pa.int64()) for name in _STEP_COUNTS),
        ]
    )

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for place, (name, rows) in enumerate(_runs(batches, step_turns)):
            codes, extra, counts = bytearray(), [], dict.fromkeys(_STEP_COUNTS, 0)
            for _, role, _, n, blank, truncated, repeated in rows:
                codes.append(code_of(role, truncated, blank or repeated))
                extra.append(n - 1)
                if blank:
                    counts["blank"] += n
                else:
                    counts["duplicate"] += n if repeated else n - 1
                    counts["truncated"] += truncated and not repeated
            initials = [row[1][:1] for row in rows]
            counts["copies"] = sum(extra)
            # A turn and its copy are no legal pair.
            counts["illegal"] = illegal_pairs(initials) + counts["copies"]
            step = {
                "conv_id": name,
                "part": part,
                "place": place,
                "codes": bytes(codes),
                "extra": extra,
                "roles": [row[1] for row in rows],
                "digests": [row[2] for row in rows],
                "costs": crossing_costs(codes),
                "first": initials[0],
                "last": initials[-1],
            }
            yield pa.RecordBatch.from_pylist([step | counts], schema)

    return steps


def _crosser(kind: pa.DataType) -> Callable:
    """The states between the steps of each conversation, and its counts."""
    schema = pa.schema(
        [
            ("conv_id", kind),
            ("part", pa.int32()),
            ("place", pa.int32()),
            ("step", pa.int64()),
            ("begin", pa.int32()),
            ("end", pa.int32()),
            ("after", pa.int32()),
            *((name, pa.int64()) for name in _COUNTS[1:]),
        ]
    )

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _runs(batches):
            states, after, cost = crossings([row[2] for row in rows])
            counts = {
                count: sum(row[5 + i] for row in rows) for i, count in enumerate(_STEP_COUNTS)
            }
            for row, later in zip(rows, rows[1:]):
                counts["illegal"] += illegal_pairs([row[4], later[3]])
            counts["cost"] = cost + DELETE * counts.pop("copies")
            steps = [
                {
                    "conv_id": name,
                    "part": row[0],
                    "place": row[1],
                    "step": step,
                    "begin": states[step],
                    "end": states[step + 1],
                    "after": after if step == len(rows) - 1 else 0,
                    **counts,
                }
                for step, row in enumerate(rows)
            ]
            yield pa.RecordBatch.from_pylist(steps, schema)

    return cross


def _solver(kind: pa.DataType) -> Callable:
    """The edits and turns of each step between its two states."""
    turn = pa.struct([("role", pa.string()), ("digest", pa.binary())])
    schema = pa.schema(
        [
            ("conv_id", kind),
            ("step", pa.int64()),
            ("audit", pa.string()),
            ("turns", pa.list_(turn)),
        ]
    )

    def solve_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, blocks = row["codes"], [""] * len(row["codes"])
                solve(codes, blocks, 0, len(codes), row["begin"], row["end"])
                state, turns, audit = row["begin"], [], []
                inserts = ("I" * row["after"], "", None, 0)
                for block, role, digest, copies in (
                    *zip(blocks, row["roles"], row["digests"], row["extra"]),
                    inserts,
                ):
                    state, made = applied(state, block, role, digest)
                    turns += [{"role": each, "digest": value} for each, value in made]
                    audit.append(block + "D" * copies)
                found = {
                    "conv_id": row["conv_id"],
                    "step": row["step"],
                    "audit": "".join(audit),
                    "turns": turns,
                }
                yield pa.RecordBatch.from_pylist([found], schema)

    return solve_steps


# What the query returns


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given another role, by a
    checksum of their names. Dropped rows stay, as ``lost``."""
    name, turn, role, text = (
        F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn", "role", "text")
    )
    fault = F.crc32(F.concat(name, F.lit(":"), turn)) % 20
    copies = F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias(
            "text"
        ),
        (fault == 0).alias("lost"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def digests(repaired: Repaired) -> DataFrame:
    """Counts and audits, with the SHA-256 of the repaired turns, ``role:text`` line by line."""
    counts = ["conv_id", *_COUNTS, "audit"]
    whole = repaired.whole.select(*counts, F.sha2(_lines(), 256).alias("repaired_sha256"))
    if repaired.audits is None:
        return whole
    joined = repaired.steps.where(F.size("turns") > 0).select(
        F.col("conv_id").alias("of_conv_id"), "step", _lines().alias("lines")
    )
    kind = _kind(repaired.audits)
    # SHA-256 reads a conversation from front to end: the lines of its steps pass through one
    # task in order, and none is held.
    sums = (
        joined.repartition("of_conv_id")
        .sortWithinPartitions("of_conv_id", "step")
        .select("of_conv_id", "lines")
        .mapInArrow(
            _hasher(to_arrow_type(kind)),
            f"of_conv_id {kind.simpleString()}, repaired_sha256 string",
        )
    )
    nothing = F.lit(hashlib.sha256().hexdigest())
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id"))
    split = repaired.audits.join(sums, same, "left").select(
        *counts, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
    return whole.unionByName(split)


def _lines() -> Column:
    line = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    return F.concat_ws("\n", line)


def _hasher(kind: pa.DataType) -> Callable:
    schema = pa.schema([("of_conv_id", kind), ("repaired_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            found = []
            for each, lines in zip(batch.column(0).to_pylist(), batch.column(1)):
                if running is not None and each == name:
                    running.update(b"\n")
                else:
                    if running is not None:
                        found.append((name, running.hexdigest()))
                    name, running = each, hashlib.sha256()
                running.update(lines.as_buffer())
            yield _sums(found)
        if running is not None:
            yield _sums([(name, running.hexdigest())])

    def _sums(found: list[tuple]) -> pa.RecordBatch:
        names, values = ([pair[i] for pair in found] for i in range(2))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, kind), pa.array(values, pa.string())], schema=schema
        )

    return hashed
