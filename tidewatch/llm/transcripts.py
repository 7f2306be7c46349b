"""Chat transcripts: roles of lines by a hidden Markov model, then canonical turns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.numbering import number_rows
from tidewatch.scratch import written

ROLES = ["system", "user", "assistant"]
# A line opens a turn of a role or goes on with it.
STATES = [(role, opens) for role in ROLES for opens in (True, False)]
# Words before a colon at the start of a line that mark a speaker.
MARKERS = {
    "system": ["system", "instructions", "context"],
    "user": ["user", "human", "customer", "question", "q"],
    "assistant": ["assistant", "ai", "bot", "model", "answer", "a"],
}
MARK = r"^\s*(?:#+\s*|\*\*|<\|)?([A-Za-z]+)(?:\*\*|\|>)?\s*[:>]\s*"
_LENGTHS = [40, 120, 400]
CHUNK = 1024
_SMOOTH, _NEVER = 0.1, 1e-9
OBSERVATIONS = (len(ROLES) + 1) * (len(_LENGTHS) + 1) * 2


def with_features(lines: DataFrame) -> DataFrame:
    """Add ``observation`` to ``lines`` (line): one number for the marker at its start (none, or
    that of a role), the class of its length, and whether it ends like a question."""
    word = F.lower(F.regexp_extract(F.coalesce("line", F.lit("")), MARK, 1))
    marker = F.lit(0)
    for i, role in enumerate(ROLES, 1):
        marker = F.when(word.isin(MARKERS[role]), i).otherwise(marker)
    length = F.length(F.coalesce("line", F.lit("")))
    size = sum((F.when(length >= n, 1).otherwise(0) for n in _LENGTHS), F.lit(0))
    asks = F.coalesce(F.col("line"), F.lit("")).rlike(r"\?\s*$").cast("int")
    return lines.withColumn("observation", ((marker * (len(_LENGTHS) + 1) + size) * 2 + asks).cast("int"))


def numbered_lines(turns: DataFrame) -> DataFrame:
    """The lines of ``turns`` (conv_id, turn, role, text) as a transcript shows them: the first line of a
    turn after its speaker's marker, ``position`` counting from 0 in each conversation.

    Turns of one number are ordered by role and text. A role that is not in ``ROLES`` leaves the
    line without marker. A conversation of any size spreads over the cluster (range partitions).
    """
    turns = turns.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    lines = turns.select(
        "conv_id", "turn", "role", "_row", F.xxhash64("text").alias("_text"), F.posexplode(F.split("text", "\n", -1)).alias("part", "line")
    )
    marked = (F.col("part") == 0) & F.col("role").isin(ROLES)
    shown = F.when(marked, F.concat(F.initcap("role"), F.lit(": "), F.col("line"))).otherwise(F.col("line"))
    lines = lines.withColumn("line", shown)
    order = [F.col(c) for c in ("turn", "role", "_text", "_row", "part")]
    return number_rows(lines, order, start=0, per=["conv_id"]).drop("_text", "_row")


def train(lines: DataFrame) -> dict[str, np.ndarray]:
    """Logarithms of the first-state, transition and emission probabilities, counted over all of
    ``lines`` (conv_id, position, part, role, observation) whose role is known. What comes to the
    driver is of fixed size: counts of states by states and of states by observations."""
    known = lines.where(F.col("role").isin(ROLES))
    place = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int")
    known = known.select(
        "conv_id", "position", "observation", (2 * (place - 1) + (F.col("part") > 0).cast("int")).alias("state")
    )
    last = known.select("conv_id", (F.col("position") + 1).alias("position"), F.col("state").alias("_last"))
    n = len(STATES)
    first, moves, shown = np.full(n, _SMOOTH), np.full((n, n), _SMOOTH), np.zeros((n, OBSERVATIONS))
    for row in known.groupBy("state", "observation").count().collect():
        shown[row["state"], row["observation"]] += row["count"]
    for row in known.join(last, ["conv_id", "position"]).groupBy("_last", "state").count().collect():
        moves[row["_last"], row["state"]] += row["count"]
    for row in known.where("position = 0").groupBy("state").count().collect():
        first[row["state"]] += row["count"]
    # A line can only go on with the role of the line before.
    for b, (role, opens) in enumerate(STATES):
        if not opens:
            first[b] = _NEVER
            moves[[a for a, (before, _) in enumerate(STATES) if before != role], b] = _NEVER
    # Marker, length and question mark are taken as independent, so rare states are smoothed little.
    cells = shown.reshape(n, len(ROLES) + 1, len(_LENGTHS) + 1, 2)
    parts = [cells.sum(axis=others) + _SMOOTH for others in ((2, 3), (1, 3), (1, 2))]
    marks, sizes, asks = (np.log(x / x.sum(axis=1, keepdims=True)) for x in parts)
    emitted = marks[:, :, None, None] + sizes[:, None, :, None] + asks[:, None, None, :]
    return {
        "first": np.log(first / first.sum()),
        "moves": np.log(moves / moves.sum(axis=1, keepdims=True)),
        "shown": emitted.reshape(n, OBSERVATIONS),
    }


def _through(observations: np.ndarray, model: dict) -> np.ndarray:
    """Best score of getting from each state before the lines to each state of the last line."""
    best = np.where(np.eye(len(STATES), dtype=bool), 0.0, -np.inf)
    for seen in observations:
        best = (best[:, :, None] + model["moves"][None]).max(axis=1) + model["shown"][:, seen]
    return best


def viterbi(observations: np.ndarray, model: dict, before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
    """The best states of consecutive lines. ``before`` has the best scores of the states of the line
    before them (none: a conversation starts), ``after`` the best scores of what follows each last
    state. Of equal scores the first state wins."""
    best, back = np.zeros(len(STATES)), []
    for i, seen in enumerate(observations):
        if i == 0 and before is None:
            scores = np.broadcast_to(model["first"], (len(STATES), len(STATES)))
        else:
            scores = (before if i == 0 else best)[:, None] + model["moves"]
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0) + model["shown"][:, seen]
    state = int((best if after is None else best + after).argmax())
    states = np.empty(len(observations), np.int64)
    for i in range(len(observations) - 1, -1, -1):
        states[i] = state
        state = int(back[i][state])
    return states


def _borders(long: DataFrame, model: dict) -> DataFrame:
    """``conv_id, chunk, before, after`` for the chunks of long conversations: each chunk is summed
    up as a table of states by states, and a conversation's tables, one for ``CHUNK`` lines, are
    combined from the left and from the right."""

    def through(key: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        seen = chunk.sort_values("position")["observation"].to_numpy()
        if key[1] == 0:
            table = _through(seen[1:], model) + (model["first"] + model["shown"][:, seen[0]])[:, None]
        else:
            table = _through(seen, model)
        return pd.DataFrame({"conv_id": [key[0]], "chunk": [key[1]], "table": [table.ravel()]})

    def across(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("chunk")
        n = len(STATES)
        tables = [np.asarray(t).reshape(n, n) for t in chunks["table"]]
        before, after = [None], [np.zeros(n)]
        reached = tables[0].max(axis=0)
        for table in tables[1:]:
            before.append(reached)
            reached = (reached[:, None] + table).max(axis=0)
        for table in reversed(tables[1:]):
            after.append((table + after[-1][None]).max(axis=1))
        return pd.DataFrame(
            {"conv_id": chunks["conv_id"], "chunk": chunks["chunk"], "before": before, "after": after[::-1]}
        )

    tables = long.groupBy("conv_id", "chunk").applyInPandas(through, "conv_id bigint, chunk bigint, table array<double>")
    schema = "conv_id bigint, chunk bigint, before array<double>, after array<double>"
    return tables.groupBy("conv_id").applyInPandas(across, schema)


def parse_transcripts(lines: DataFrame, model: dict) -> DataFrame:
    """``lines`` (conv_id, position, line and others) with ``state_role``, ``opens`` and ``rendered``.

    Roles are the best path through the hidden Markov model ``model`` for each conversation, by
    the markers, lengths and question marks of its lines; ``opens`` says whether a line opens a turn.
    ``rendered`` is the line in canonical form: ``<|role|>`` and a line break before the first line of a
    turn, without the marker it had. Joined by line breaks in order of ``position`` they are the
    transcript, and a turn ends where the next one opens.

    Tasks get at most ``CHUNK`` lines of a conversation together. Conversations that are longer are
    decoded by chunks whose borders are settled before, with the same result. NULL lines are
    empty lines; lines without conv_id are one conversation. ``position`` counts from 0. Columns named
    like the results or the helpers ``chunk, observation, before, after`` are left out.
    """
    results = ["state_role", "opens", "rendered"]
    helpers = ["chunk", "observation", "before", "after", "_conv", "_chunk"]
    kept = [c for c in lines.columns if c not in (*results, *helpers)]
    lines = with_features(lines.select(*kept))
    lines = lines.withColumn("chunk", F.floor(F.col("position") / CHUNK).cast("bigint"))
    long = lines.where(F.col("position") >= CHUNK).select("conv_id").distinct()
    same = lines["conv_id"].eqNullSafe(long["conv_id"])
    long_lines = lines.join(long, same, "left_semi").select("conv_id", "chunk", "position", "observation")
    borders = written(_borders(long_lines, model), "borders")
    borders = borders.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), "before", "after")
    placed = lines.join(borders, lines["conv_id"].eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left")
    placed = placed.drop("_conv", "_chunk").repartition("conv_id", "chunk")
    placed = placed.sortWithinPartitions("conv_id", "chunk", "position")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            group = batch["conv_id"].fillna(-1).astype("int64"), batch["chunk"]
            changed = (group[0] != group[0].shift()) | (group[1] != group[1].shift())
            changed |= batch["conv_id"].isna() != batch["conv_id"].isna().shift(fill_value=False)
            starts = np.flatnonzero(changed.to_numpy())
            if len(starts):
                if starts[-1]:
                    yield decoded(batch.iloc[: starts[-1]], starts[:-1])
                held = batch.iloc[starts[-1] :]
        if held is not None and len(held):
            yield decoded(held, [0])

    def decoded(rows: pd.DataFrame, starts) -> pd.DataFrame:
        states = np.empty(len(rows), np.int64)
        bounds = [*starts, len(rows)]
        seen = rows["observation"].to_numpy()
        for start, stop in zip(bounds, bounds[1:]):
            border = [rows[c].iloc[start] for c in ("before", "after")]
            border = [None if b is None else np.asarray(b, float) for b in border]
            states[start:stop] = viterbi(seen[start:stop], model, *border)
        roles = [STATES[s][0] for s in states]
        opens = [STATES[s][1] for s in states]
        return rows[kept].assign(state_role=roles, opens=opens)

    schema = placed.select(*kept).schema.add("state_role", "string").add("opens", "boolean")
    found = placed.mapInPandas(each, schema)
    bare = F.regexp_replace(F.coalesce("line", F.lit("")), MARK, "")
    marked = F.lower(F.regexp_extract(F.coalesce("line", F.lit("")), MARK, 1)).isin(
        [word for words in MARKERS.values() for word in words]
    )
    opening = F.concat(F.lit("<|"), F.col("state_role"), F.lit("|>\n"), F.when(marked, bare).otherwise(F.col("line")))
    return found.withColumn("rendered", F.coalesce(F.when(F.col("opens"), opening), F.col("line"), F.lit("")))
