"""Event-pattern detection per key on ordered event tables.

Sequences are found with running values (previous row, next matching row), so a
key's history is never held in one place and a hot key splits over time chunks.
Chosen semantics: *strict* means adjacent rows of the key; *followed by* takes
the first later match and skips other rows; the time limit is inclusive and
counts from the first event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import By, Running, running, settle, with_chunks


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def strict_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    conditions: Sequence[Column],
    within_seconds: int,
    carry: Sequence[str],
) -> DataFrame:
    """Adjacent rows that satisfy the conditions in turn.

    One row per match with the ``carry`` columns of every event, suffixed
    ``_1``, ``_2``, ...; the first order column is the time.
    """
    n = len(conditions)
    event = F.struct(*[F.col(c) for c in dict.fromkeys([order[0], *carry])])
    flags = df.withColumns({f"__is{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(conditions)})
    # Only keys, order and the event travel on: the steps below write what they get.
    packed = flags.select(
        *dict.fromkeys([*keys, *order]),
        F.struct(event.alias("event"), *[F.col(f"__is{i}") for i in range(n)]).alias("__e0"),
    )
    packed = with_chunks(packed, order)
    for back in range(1, n):
        packed = settle(
            running(packed, keys, order, [Running(f"__e{back}", "lag", F.col(f"__e{back - 1}"))])
        )
    found = F.lit(True)
    for back in range(n):
        found &= F.coalesce(F.col(f"__e{back}")[f"__is{n - 1 - back}"], F.lit(False))
    first = F.col(f"__e{n - 1}.event.{order[0]}")
    last = F.col(f"__e0.event.{order[0]}")
    found &= micros(last) - micros(first) <= within_seconds * 1_000_000
    return packed.where(found).select(
        *keys,
        *[
            F.col(f"__e{n - 1 - i}.event.{c}").alias(f"{c}_{i + 1}")
            for i in range(n)
            for c in carry
        ],
    )


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    conditions: Sequence[Column],
    within_seconds: int,
    carry: Sequence[str],
) -> DataFrame:
    """For each first event, the first later match of each further condition.

    Returns every start with ``matched`` telling whether the sequence completed
    within the limit; an incomplete one is the timed-out partial match.
    """
    n = len(conditions)
    backwards = [By(c, False) for c in order]
    event_cols = list(dict.fromkeys([order[0], *carry]))
    flags = [F.coalesce(c, F.lit(False)).alias(f"__is{i}") for i, c in enumerate(conditions)]
    # Only keys, order, event and flags travel on: the steps below write what they get.
    frame = with_chunks(df.select(*dict.fromkeys([*keys, *order, *event_cols]), *flags), backwards)
    previous: str | None = None
    for i in range(n - 1, 0, -1):
        own = F.struct(
            *[F.col(c).alias(f"{c}_{i + 1}") for c in event_cols],
            *(
                []
                if previous is None
                else [
                    F.col(f"{previous}.{c}_{j + 1}").alias(f"{c}_{j + 1}")
                    for j in range(i + 1, n)
                    for c in event_cols
                ]
            ),
        )
        at_match = F.when(F.col(f"__is{i}"), own)
        frame = frame.withColumn(f"__m{i}", at_match)
        # Strictly after the row: its own match is not its successor.
        frame = settle(
            running(
                frame, keys, backwards, [Running(f"__next{i}", "last_before", F.col(f"__m{i}"))]
            )
        )
        previous = f"__next{i}"
    starts = frame.where("__is0")
    last_time = F.col(f"{previous}.{order[0]}_{n}")
    span = micros(last_time) - micros(F.col(order[0]))
    matched = F.coalesce(span <= within_seconds * 1_000_000, F.lit(False))
    return starts.select(
        *keys,
        *[F.col(c).alias(f"{c}_1") for c in carry],
        *[
            F.when(matched, F.col(f"{previous}.{c}_{j + 1}")).alias(f"{c}_{j + 1}")
            for j in range(1, n)
            for c in carry
        ],
        matched.alias("matched"),
    )


def illegal_transitions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, allowed: dict[str, Sequence[str]]
) -> DataFrame:
    """Rows whose state may not follow the previous state of their key."""
    seen = running(df, keys, order, [Running("previous_state", "lag", F.col(state))])
    legal = F.lit(False)
    for before, following in allowed.items():
        legal |= (F.col("previous_state") == before) & F.col(state).isin(*following)
    return seen.where(F.col("previous_state").isNotNull() & ~legal)
