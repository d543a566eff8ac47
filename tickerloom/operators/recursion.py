"""Indicators continued from a stored state per series (row K9): a run reads new days only.

The state holds what the recursions need: the averages with their weights, the runs of equal sign, and as many
last rows as the longest window looks back (239 closes and volumes, 8 highs and lows). It does not grow with the
history. A step over new rows equals the same rows of a full run.

Quotes, flows and states are united and dealt by series once (`united`): a flow meets its quote where they lie side by
side. Indicators and next states are two readings of that table, so that no indicator is stored for the sake of the states.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.numbers import rounded
from tickerloom.operators.series import dealt, mapped

# Name: smoothing factor, weights of a finite history (adjusted), values needed.
AVERAGES = {
    "k": (1 / 3, False, 1), "d": (1 / 3, False, 1), "up6": (1 / 6, True, 6), "down6": (1 / 6, True, 6), "up12": (1 / 12, True, 12),
    "down12": (1 / 12, True, 12), "fast": (2 / 13, False, 1), "slow": (2 / 27, False, 1), "dea": (2 / 10, False, 1),
}
RANGE_ROWS, BAND_ROWS = 9, 20
VALUES = ["close", "volume", "high", "low"]
STATE = "s_last string, s_close array<double>, s_volume array<double>, s_high array<double>, s_low array<double>, s_averages array<double>, s_runs array<bigint>"
STATE_COLUMNS = [part.split()[0] for part in STATE.split(", ")]
LISTS = STATE_COLUMNS[1:]
# Kinds of united rows, in their order within a day.
STORED, FLOW, QUOTE = 0, 1, 2


class TimeMajor:
    """Rows of many series, each in order, turned so that equal steps of all series lie side by side: longest series first."""

    def __init__(self, first: np.ndarray, counts: np.ndarray):
        self.series = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[self.series] = np.arange(len(counts))
        at = np.arange(counts.sum()) - np.repeat(first, counts)
        self.rows = np.lexsort((np.repeat(rank, counts), at))
        self.ends = np.cumsum(np.bincount(at))

    def averaged(self, values: np.ndarray, state: np.ndarray, names: Sequence[str]) -> np.ndarray:
        """Exponential averages (name, row) of `values` after `state` (series, name, (average, weight of what went before, values seen)), which moves on.

        A missing value keeps the average and lets its weight decay.
        """
        factor, adjusted, need = (np.array([AVERAGES[n][i] for n in names])[:, None] for i in range(3))
        new = np.where(adjusted, 1.0, factor)
        mean, weight, seen = (np.ascontiguousarray(state[self.series, :, i].T) for i in range(3))
        turned = values[:, self.rows]
        made = np.empty_like(turned)
        begin = 0
        for end in self.ends:
            x, n = turned[:, begin:end], end - begin
            m, w = mean[:, :n], weight[:, :n]
            there, known = x == x, m == m
            w = np.where(known, w * (1 - factor), w)
            moved = np.where(m != x, (w * m + new * x) / (w + new), m)
            mean[:, :n] = m = np.where(there, np.where(known, moved, x), m)
            weight[:, :n] = np.where(there, np.where(known & adjusted, w + new, 1.0), w)
            seen[:, :n] += there
            made[:, begin:end] = np.where(seen[:, :n] >= need, m, np.nan)
            begin = end
        state[self.series] = np.stack([mean.T, weight.T, seen.T], axis=2)
        out = np.empty_like(made)
        out[:, self.rows] = made
        return out


def windowed(values: np.ndarray, place: np.ndarray, rows: int, how) -> np.ndarray:
    """`how` over the `rows` values up to each one of its series, in which it has that `place`; missing while any of them is."""
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    made = how(np.lib.stride_tricks.sliding_window_view(padded, rows), axis=1)
    return np.where(place >= rows - 1, made, np.nan)


def run_lengths(values: np.ndarray, first: np.ndarray, counts: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Signed length of the run of equal signs at each value, continued from `state` (series, (sign, length)); a zero or missing value is 0."""
    sign = np.sign(np.nan_to_num(values)).astype(np.int64)
    new = np.diff(sign, prepend=0) != 0
    new[first] = True
    at = np.maximum.accumulate(np.where(new, np.arange(len(sign)), 0))
    carried = np.where(state[:, 0] == sign[first], state[:, 1], 0)
    length = np.arange(len(sign)) - at + 1 + np.where(at == np.repeat(first, counts), np.repeat(carried, counts), 0)
    last = first + counts - 1
    state[:, 0], state[:, 1] = sign[last], length[last]
    return sign * length


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All row numbers of the ranges."""
    return np.arange(counts.sum()) + np.repeat(first - np.cumsum(counts) + counts, counts)


def _lists(values: np.ndarray, counts: np.ndarray, last: np.ndarray, rows: int) -> pa.Array:
    """A list per series at its last row, nothing at the others."""
    sizes, there = np.zeros(rows, np.int64), np.zeros(rows, bool)
    sizes[last], there[last] = counts, True
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=pa.array(~there))


class _Stored:
    """The states of a `united` table: the lists of a state follow one another in `_state`, after their sizes."""

    def __init__(self, table: pa.Table):
        lists = table["_state"].combine_chunks()
        self.table, self.begin, self.values = table, lists.offsets.to_numpy()[:-1].astype(np.int64), lists.values.to_numpy(zero_copy_only=False)

    def lists(self, name: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the lists at `rows` one after the other, and how many each row has: none at a row below 0."""
        at, there = self.begin[np.maximum(rows, 0)], rows >= 0
        if not there.any():
            return np.zeros(0), np.zeros(len(rows), np.int64)
        sizes = np.where(there[:, None], self.values[np.where(there, at, at[there][0])[:, None] + np.arange(len(LISTS))], 0).astype(np.int64)
        nth = LISTS.index(name)
        return self.values[_ranges(at + len(LISTS) + sizes[:, :nth].sum(axis=1), sizes[:, nth])], sizes[:, nth]

    def rows(self, rows: np.ndarray) -> pa.Table:
        made = {c: self.table[c].take(pa.array(rows)).combine_chunks() for c in ("symbol", "s_last")}
        for name in LISTS:
            values, sizes = self.lists(name, rows)
            made[name] = _lists(values.astype(np.int64) if name == "s_runs" else values, sizes, np.arange(len(rows)), len(rows))
        return pa.table(made)


def _quote_rows(table: pa.Table, number: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of quotes, and for each the row that its nets are read from: a flow of its symbol and day, or itself where there is none.

    As in a left join, a quote comes once for each flow of its day, and a missing symbol or day has no flow.
    """
    quotes = np.flatnonzero(kind == QUOTE)
    if not (kind == FLOW).any():
        return quotes, quotes
    days = table["date"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    stored = kind == STORED
    begins = (np.diff(number, prepend=-1) != 0) | (np.diff(days, prepend=-2) != 0) | stored | np.concatenate([[False], stored[:-1]])
    group = np.cumsum(begins) - 1
    known = (days >= 0) & table["symbol"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    flows = np.where(known[quotes], np.bincount(group, kind == FLOW).astype(np.int64)[group[quotes]], 0)
    times = np.maximum(flows, 1)
    rows = np.repeat(quotes, times)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
    return rows, np.where(np.repeat(flows, times) > 0, np.flatnonzero(begins)[group[rows]] + nth, rows)


def step_of(lengths: Sequence[int], nets: Sequence[str], columns: Sequence[str], indicators: bool = True, states: bool = True, digits: int | None = None):
    """The function of many series of a `united` table: their new rows (`columns`) with indicators, their next states, or both.

    States alone are a row per series, also for one without new rows, which keeps its state. Beside indicators a state
    stands in its series' last row. `digits` rounds the indicators, never the states.
    """
    keep = max(lengths) - 1
    taken = list(dict.fromkeys(["symbol", "date", *VALUES, *nets, *columns]))

    def step(table: pa.Table, first: np.ndarray) -> pa.Table:
        table = table.combine_chunks()
        number = np.repeat(np.arange(len(first)), np.diff(first, append=table.num_rows))
        kind = table["_kind"].to_numpy()
        states_of = _Stored(table) if "_state" in table.column_names else None
        old = np.where(kind[first] == STORED, first, -1)
        rows, nets_from = _quote_rows(table, number, kind)
        if states_of:
            before = old[number[rows]]
            later = pc.greater(table["date"].take(pa.array(rows)), table["s_last"].take(pa.array(before, mask=before < 0))).fill_null(False).to_numpy()
            wanted = later | (before < 0)
            rows, nets_from = rows[wanted], nets_from[wanted]
        new = pa.table({c: table[c].take(pa.array(nets_from if c in nets else rows)).combine_chunks() for c in taken})
        present, first, counts = np.unique(number[rows], return_index=True, return_counts=True)
        unmoved = [states_of.rows(np.flatnonzero((kind == STORED) & ~np.isin(number, present)))] if states_of and not indicators else []
        if not new.num_rows:
            return unmoved[0] if unmoved else new.select(columns)
        old, last = old[present], first + counts - 1

        def stored_lists(name: str) -> tuple[np.ndarray, np.ndarray]:
            """Values of the stored lists one after the other, and how many each series has."""
            return states_of.lists(f"s_{name}", old) if states_of else (np.zeros(0), np.zeros(len(old), np.int64))

        values = {c: new[c].to_numpy().astype(float) for c in (*VALUES, *nets)}
        series, places, shown, ends = {}, {}, {}, {}
        for c in VALUES:
            before, sizes = stored_lists(c)
            total = sizes + counts
            begin = np.cumsum(total) - total
            shown[c], ends[c] = _ranges(begin + sizes, counts), (begin, total)
            series[c] = np.empty(total.sum())
            series[c][_ranges(begin, sizes)] = before
            series[c][shown[c]] = values[c]
            places[c] = np.arange(total.sum()) - np.repeat(begin, total)

        averages = np.tile([np.nan, 1.0, 0.0], (len(old), len(AVERAGES), 1))
        runs = np.zeros((len(old), len(nets), 2), np.int64)
        if (old >= 0).any():
            averages[old >= 0] = stored_lists("averages")[0].reshape(-1, len(AVERAGES), 3)
            runs[old >= 0] = stored_lists("runs")[0].reshape(-1, len(nets), 2)
        turned = TimeMajor(first, counts)

        def average(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
            at = [list(AVERAGES).index(name) for name in inputs]
            state = averages[:, at]
            made = turned.averaged(np.stack(list(inputs.values())), state, list(inputs))
            averages[:, at] = state
            return dict(zip(inputs, made))

        def over(c: str, n: int, how) -> np.ndarray:
            return windowed(series[c], places[c], n, how)[shown[c]]

        out = {}
        if indicators:
            for c, prefix in (("close", "ma"), ("volume", "vma")):
                for n in lengths:
                    out[f"{prefix}{n}"] = over(c, n, np.mean)
        low, high, close = over("low", RANGE_ROWS, np.min), over("high", RANGE_ROWS, np.max), values["close"]
        with np.errstate(divide="ignore", invalid="ignore"):
            rsv = np.where(high > low, (close - low) / (high - low) * 100, np.nan)
            rsv = np.where(np.isnan(rsv), 50.0, rsv)
            change = np.where(places["close"] > 0, np.diff(series["close"], prepend=np.nan), np.nan)[shown["close"]]
            up, down = (np.where(np.isnan(change), np.nan, np.maximum(c, 0)) for c in (change, -change))
            made = average({"k": rsv, "up6": up, "down6": down, "up12": up, "down12": down, "fast": close, "slow": close})
            out["k"], out["macd_dif"] = made["k"], made["fast"] - made["slow"]
            for n in (6, 12):
                out[f"rsi{n}"] = 100 - 100 / (1 + made[f"up{n}"] / made[f"down{n}"])
            made = average({"d": out["k"], "dea": out["macd_dif"]})
        out["d"], out["macd_dea"] = made["d"], made["dea"]
        out["macd_hist"] = out["macd_dif"] - out["macd_dea"]
        if indicators:
            spread = over("close", BAND_ROWS, lambda v, axis: np.std(v, axis=axis, ddof=1))
            middle = over("close", BAND_ROWS, np.mean)
            out |= {"bb_upper": middle + 2 * spread, "bb_middle": middle, "bb_lower": middle - 2 * spread}
        for i, c in enumerate(nets):
            out[_streak(c)] = run_lengths(values[c], first, counts, runs[:, i])
        shape = (last, new.num_rows) if indicators else (np.arange(len(last)), len(last))
        dates = new["date"].combine_chunks()
        if indicators:
            ending = np.zeros(new.num_rows, bool)
            ending[last] = True
            state = {"s_last": pc.if_else(pa.array(ending), dates, pa.scalar(None, dates.type))}
        else:
            state = {"s_last": dates.take(pa.array(last))}
        for c, k in {"close": keep, "volume": keep, "high": RANGE_ROWS - 1, "low": RANGE_ROWS - 1}.items():
            begin, total = ends[c]
            held = np.minimum(total, k) if k else total
            state[f"s_{c}"] = _lists(series[c][_ranges(begin + total - held, held)], held, *shape)
        state["s_averages"] = _lists(averages.reshape(-1), np.full(len(old), 3 * len(AVERAGES)), *shape)
        state["s_runs"] = _lists(runs.reshape(-1), np.full(len(old), 2 * len(nets)), *shape)
        if not indicators:
            fresh = pa.table({"symbol": new["symbol"].combine_chunks().take(pa.array(last)), **state})
            return pa.concat_tables([fresh.filter(fresh["s_last"].is_valid()), *unmoved])
        if digits is not None:
            out |= {name: rounded(values, digits) for name, values in out.items() if values.dtype == float}
        shown_columns = {name: pa.array(out[name], from_pandas=True) for name in _names(lengths, nets)}
        return pa.table({**{c: new[c] for c in columns}, **shown_columns, **(state if states else {})})

    return step


def _streak(net: str) -> str:
    return net.replace("_net", "_streak_days")


def _names(lengths: Sequence[int], nets: Sequence[str]) -> list[str]:
    means = [f"{p}{n}" for p in ("ma", "vma") for n in lengths]
    return [*means, "k", "d", "rsi6", "rsi12", "macd_dif", "macd_dea", "macd_hist", "bb_upper", "bb_middle", "bb_lower", *[_streak(c) for c in nets]]


def united(quotes: DataFrame, flows: DataFrame | None, state: DataFrame | None) -> DataFrame:
    """Stored states, flows (date, symbol, nets) and quotes, dealt by symbol once; a series' state comes first, a day's flow before its quote."""
    df = quotes.withColumn("_kind", F.lit(QUOTE).cast("tinyint"))
    if flows is not None:
        df = df.unionByName(flows.withColumn("_kind", F.lit(FLOW).cast("tinyint")), allowMissingColumns=True)
    if state is not None:
        flat = F.concat(F.array(*[F.size(c).cast("double") for c in LISTS]), *[F.col(c).cast("array<double>") for c in LISTS])
        old = state.select("symbol", F.lit(STORED).cast("tinyint").alias("_kind"), "s_last", flat.alias("_state"))
        df = df.unionByName(old, allowMissingColumns=True)
    return dealt(df, "symbol", [F.col("_kind") != STORED, F.col("date").asc_nulls_last(), F.col("_kind")])


def _read(df: DataFrame, step, schema: str) -> DataFrame:
    """`step` over a `united` table. Lists go to Arrow empty where missing: a batch's size is taken at each row, at the cost of all missing lists before it."""
    if "_state" in df.columns:
        df = df.withColumn("_state", F.coalesce("_state", F.array().cast("array<double>")))
    return mapped(df, "symbol", step, schema)


def _schema(df: DataFrame, columns: Sequence[str], lengths: Sequence[int], nets: Sequence[str]) -> str:
    kinds = {name: "bigint" if name in map(_streak, nets) else "double" for name in _names(lengths, nets)}
    return ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns], *[f"{n} {t}" for n, t in kinds.items()]])


def indicators(df: DataFrame, lengths: Sequence[int], nets: Sequence[str], digits: int | None = None) -> DataFrame:
    """date, symbol and all indicators of the new rows of a `united` table, rounded like `numbers.rnd` if `digits` are given."""
    columns = ["date", "symbol"]
    return _read(df, step_of(lengths, nets, columns, states=False, digits=digits), _schema(df, columns, lengths, nets))


def next_states(df: DataFrame, lengths: Sequence[int], nets: Sequence[str]) -> DataFrame:
    """symbol and state after a `united` table; a symbol without new rows keeps its state."""
    return _read(df, step_of(lengths, nets, [], indicators=False), f"symbol {df.schema['symbol'].dataType.simpleString()}, {STATE}")


def with_continued_indicators(df: DataFrame, state: DataFrame | None, lengths: Sequence[int], nets: Sequence[str]) -> DataFrame:
    """`df` (date, symbol, high, low, close, volume, nets) with all indicators; a symbol's last row carries its next state.

    Rows up to the state's last day are left out: a repeated run adds nothing. One row per symbol and day.
    """
    schema = f"{_schema(df, df.columns, lengths, nets)}, {STATE}"
    return _read(united(df, None, state), step_of(lengths, nets, df.columns), schema)
