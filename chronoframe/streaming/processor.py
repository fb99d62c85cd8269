"""The keyed stateful fold: sliding-window means, running counts and ordered
emission (S1, S2, S3, S5).

:class:`WindowFold` serves one view key, :class:`ShardFold` (which :func:`view_stream`
runs) a shard of them in the same way. Per key there are

* ``buf``   -- events received but not yet emitted (the watermark has not passed them);
* ``tiles`` -- emitted events still inside the window of any future event, by tile of
  time (``TILES`` to a window): per tile its distinct timestamps with their signal sums
  and non-NULL counts, so a burst of tied events costs one entry;
* ``dir``   -- per tile the totals of sums and counts, and the running totals of the
  cumulative signals.

Events are emitted only when the event-time watermark passes them, in event
time order, one tie group at a time: every event of a group is read against
the state *before* any of them is appended, so the stream gives the batch
result (``ties="exclude"``) whatever the arrival order inside the watermark
delay. A window is whole tiles, known by their totals, and two cut ones: only tiles
that a window's edge cuts are read, only tiles that gain events are written, and
tiles out of every future window are removed. All of a key's ready events go
through one set of NumPy prefix sums and ``searchsorted``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


#: Tiles of time to a window.
TILES = 16
#: Rows of a shard that are folded at once, and rows of an arrival that is cut by tile.
STEP_ROWS, PART_ROWS = 1 << 18, 1 << 16
#: Tile of a part of rows that is not cut by tile.
NO_TILE = -(1 << 62)


def _schema(fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


class WindowFold(StatefulProcessor):
    """S1 + S2 + S3 for one key: emits ``keys, event_id, ts_us, <rolling>, <cumulative>``."""

    def __init__(
        self,
        keys: Sequence[str],
        signals: Sequence[str],
        window_us: int,
        rolling_names: Sequence[str],
        cumulative: Sequence[str] = (),
        cumulative_names: Sequence[str] = (),
        id_col: str = "event_id",
        event_time: str = "",
    ):
        self.keys = list(keys)
        self.signals = list(signals)
        self.window_us = int(window_us)
        self.rolling_names = list(rolling_names)
        self.cumulative = list(cumulative)
        self.cumulative_names = list(cumulative_names)
        self.id_col = id_col
        self.event_time = event_time
        self.tile_us = max(1, -(-self.window_us // TILES))
        self._cum_idx = [self.signals.index(s) for s in self.cumulative]

    # -- schemas -------------------------------------------------------------
    def input_columns(self) -> list[str]:
        return [*self.keys, self.id_col, "ts_us", *self.signals]

    def output_schema(self, key_types: Sequence[T.DataType]) -> T.StructType:
        return _schema(
            [(k, t) for k, t in zip(self.keys, key_types)]
            + [(self.id_col, T.LongType()), ("ts_us", T.LongType())]
            + [(n, T.DoubleType()) for n in self.rolling_names]
            + [(n, T.LongType()) for n in self.cumulative_names]
            + [("late", T.BooleanType())]
            + [(n, T.TimestampType()) for n in [self.event_time] if n]
        )

    def _timed(self, out: pd.DataFrame) -> pd.DataFrame:
        """With the event time as a timestamp (of UTC), if a later operator goes by it."""
        if self.event_time:
            out[self.event_time] = pd.to_datetime(out["ts_us"], unit="us", utc=True)
        return out

    def init(self, handle: StatefulProcessorHandle) -> None:
        sig = [(f"s{i}", T.DoubleType()) for i in range(len(self.signals))]
        longs, doubles = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
        self.handle = handle
        self.buf = handle.getListState("buf", _schema([("us", T.LongType()), ("eid", T.LongType()), *sig]))
        self.tiles = handle.getMapState("tiles", _schema([("tile", T.LongType())]), _schema([("us", longs), ("s", doubles), ("n", longs)]))
        self.dir = handle.getValueState("dir", _schema([("tile", longs), ("s", doubles), ("n", longs), ("c", longs)]))

    # -- callbacks (called by keyword: names must stay as they are) ------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm_us = int(timerValues.getCurrentWatermarkInMs()) * 1000
        held, late = [], []
        for pdf in rows:
            pdf = pdf[pdf["ts_us"].notna()]
            # Everything at or below the watermark has been emitted already;
            # a row that old cannot be folded in order. It is emitted at once,
            # flagged ``late`` and without features, and never enters state.
            behind = pdf["ts_us"].to_numpy(np.int64) <= (wm_us if wm_us > 0 else -(1 << 63))
            if behind.any():
                late.append(self._late_rows(key, pdf[behind]))
                pdf = pdf[~behind]
            cols = [pdf["ts_us"].to_numpy(np.int64).tolist(), _nulled(pdf[self.id_col], int)]
            held += zip(*cols, *(_nulled(pdf[s], float) for s in self.signals))
        if held:
            self.buf.appendList(held)
            # One timer at the earliest new event is enough: expiry re-arms for what is left.
            self.handle.registerTimer(min(r[0] for r in held) // 1000 + 1)
        return iter(late)

    def _late_rows(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({self.id_col: pdf[self.id_col].to_numpy(), "ts_us": pdf["ts_us"].astype("int64").to_numpy()})
        key_vals = key if isinstance(key, tuple) else (key,)
        for i, (name, v) in enumerate(zip(self.keys, key_vals)):
            out.insert(i, name, v)
        for name in self.rolling_names:
            out[name] = np.nan
        for name in self.cumulative_names:
            out[name] = pd.array([None] * len(out), dtype="Int64")
        out["late"] = True
        return self._timed(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = int(timerValues.getCurrentWatermarkInMs()) * 1000
        out = self._emit(key, wm_us)
        return iter([out]) if out is not None else iter([])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Seed tiles and running totals from history rows ``(kind, us, s*, n*, c*)``."""
        k = len(self.signals)
        w = initialState[initialState["kind"] == "w"]
        us = w["us"].to_numpy(np.int64)
        s = w[[f"s{i}" for i in range(k)]].to_numpy(np.float64)
        n = w[[f"n{i}" for i in range(k)]].to_numpy(np.int64)
        c = initialState.loc[initialState["kind"] == "c", [f"c{i}" for i in range(len(self.cumulative))]]
        counts = np.array([int(x) for x in c.fillna(0).astype("int64").sum(axis=0)], np.int64)
        self._store(_Tiles.of(us, s, n, self.tile_us), {}, counts, -(1 << 62))

    def close(self) -> None:
        pass

    # -- state ---------------------------------------------------------------------
    def _directory(self) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Totals per tile, and the running totals."""
        k, got = len(self.signals), self.dir.get()
        if got is None:
            return {}, np.zeros(len(self.cumulative), np.int64)
        tile, s, n, c = got
        s, n = np.array(s, np.float64).reshape(-1, k), np.array(n, np.int64).reshape(-1, k)
        return {t: (s[i], n[i]) for i, t in enumerate(tile)}, np.array(c, np.int64)

    def _tile(self, tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        us, s, n = self.tiles.getValue((tile,))
        k = len(self.signals)
        return np.array(us, np.int64), np.array(s, np.float64).reshape(-1, k), np.array(n, np.int64).reshape(-1, k)

    def _store(self, touched: dict, totals: dict, counts: np.ndarray, from_us: int) -> None:
        """Write the touched tiles and the directory; tiles that end by ``from_us`` go."""
        for tile in [t for t in totals if (t + 1) * self.tile_us <= from_us]:
            self.tiles.removeKey((tile,))
            del totals[tile]
        for tile, (us, s, n) in touched.items():
            if (tile + 1) * self.tile_us <= from_us:
                continue
            self.tiles.updateValue((tile,), (us.tolist(), s.ravel().tolist(), n.ravel().tolist()))
            totals[tile] = (s.sum(axis=0), n.sum(axis=0))
        order = sorted(totals)
        s, n = ([x for t in order for x in totals[t][i].tolist()] for i in (0, 1))
        self.dir.update((order, s, n, counts.tolist()))

    # -- the fold ----------------------------------------------------------------
    def _emit(self, key, wm_us: int) -> pd.DataFrame | None:
        k = len(self.signals)
        rows = list(self.buf.get())
        rest = [tuple(r) for r in rows if r[0] > wm_us]
        ready = sorted((tuple(r) for r in rows if r[0] <= wm_us), key=lambda r: r[0])
        if not ready:
            return None
        t = np.array([r[0] for r in ready], np.int64)
        given = np.array([r[2:] for r in ready], np.float64).reshape(-1, k)  # NaN: no value
        known = ~np.isnan(given)
        value = np.where(known, given, 0.0)
        totals, counts = self._directory()

        # Tiles that the edge of some window cuts, or that gain events, one by one;
        # the others as one entry each, at their start.
        fresh = _Tiles.of(t, value, known.astype(np.int64), self.tile_us)
        cut = {int(x) for x in np.unique((t - self.window_us) // self.tile_us)} | set(fresh)
        whole = {x: self._tile(x) for x in cut if x in totals}
        parts = [*whole.values(), *fresh.values()]
        rough = [x for x in totals if x not in whole]
        if rough:
            parts.append((np.array(rough, np.int64) * self.tile_us, np.array([totals[x][0] for x in rough]), np.array([totals[x][1] for x in rough])))
        us, s, n = _Tiles.merged(parts)
        sums = np.vstack([np.zeros((1, k)), np.cumsum(s, axis=0)])
        nums = np.vstack([np.zeros((1, k), np.int64), np.cumsum(n, axis=0)])
        lo = np.searchsorted(us, t - self.window_us, side="left")
        hi = np.searchsorted(us, t, side="left")  # tied peers and the event itself excluded
        total, seen = sums[hi] - sums[lo], nums[hi] - nums[lo]
        mean = np.where(seen > 0, total / np.maximum(seen, 1), np.nan)

        out: dict = dict(zip(self.keys, key if isinstance(key, tuple) else (key,)))
        out |= {self.id_col: pd.array([r[1] for r in ready], dtype="Int64"), "ts_us": t}
        out |= {name: mean[:, i] for i, name in enumerate(self.rolling_names)}
        if self.cumulative:
            own = value[:, self._cum_idx].astype(np.int64)
            run = np.vstack([np.zeros((1, own.shape[1]), np.int64), np.cumsum(own, axis=0)])
            prior = counts + run[np.searchsorted(t, t, side="left")]
            out |= {name: prior[:, j] for j, name in enumerate(self.cumulative_names)}
            counts = counts + run[-1]

        # Keep what any later event (time > watermark) can still see.
        touched = {x: _Tiles.merged([whole[x], fresh[x]]) if x in whole else fresh[x] for x in fresh}
        self._store(touched, totals, counts, wm_us - self.window_us)
        if rest:
            self.buf.put(rest)
            self.handle.registerTimer(min(r[0] for r in rest) // 1000 + 1)
        else:
            self.buf.clear()
        return self._timed(pd.DataFrame(out | {"late": False}, index=range(len(ready))))


class ShardFold(WindowFold):
    """The same fold for many keys to a group (``shard``), so that a key costs array
    entries and not state calls of its own: a view may have as many keys as events.

    State holds Arrow batches. ``buf`` has the rows not yet emitted, a large arrival cut
    by tile; ``tiles`` per tile the entries of all keys, ``sums`` their totals per key;
    ``counts`` the running totals per key; ``dir`` the parts of ``buf`` and the tiles that
    there are. Ready tiles are folded in time order, ``STEP_ROWS`` rows at a time, so that
    a shard with one huge key holds a step and the tiles its windows cut.

    Numeric keys and ids come as 0 where null, with bit i of ``nulls`` set for the i-th
    of ``[*keys, id_col]``: a null would turn a whole Arrow column of ids into doubles.
    """

    def __init__(self, *args, shard: str = "shard__", nulls: str = "nulls__", **kwargs):
        super().__init__(*args, **kwargs)
        self.shard, self.nulls = shard, nulls
        k, c = range(len(self.signals)), range(len(self.cumulative))
        self._who = [*self.keys, self.nulls]  # what tells keys apart, with the keys' bits of nulls only
        self._sums, self._nums, self._runs = [f"s{i}" for i in k], [f"n{i}" for i in k], [f"c{i}" for i in c]

    def input_columns(self) -> list[str]:
        return [self.shard, *self.keys, self.nulls, self.id_col, "ts_us", *self.signals]

    def output_schema(self, key_types: Sequence[T.DataType]) -> T.StructType:
        plain = super().output_schema(key_types)
        return T.StructType([*plain, T.StructField(self.nulls, T.LongType(), True)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        longs, blob = T.ArrayType(T.LongType()), _schema([("rows", T.BinaryType())])
        self.handle = handle
        self.buf = handle.getMapState("buf", _schema([("part", T.LongType())]), blob)
        self.tiles = handle.getMapState("tiles", _schema([("tile", T.LongType())]), blob)
        self.sums = handle.getMapState("sums", _schema([("tile", T.LongType())]), blob)
        self.counts = handle.getValueState("counts", blob)
        # Parts with their tile (NO_TILE: any), rows and least time; tiles; next part.
        self.dir = handle.getValueState("dir", _schema([("part", longs), ("tile", longs), ("n", longs), ("least", longs), ("live", longs), ("next", T.LongType())]))

    # -- callbacks -------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm_us = int(timerValues.getCurrentWatermarkInMs()) * 1000
        held, late, n, least = [], [], 0, None
        parts, live, at = self._read_dir()
        for pdf in rows:
            pdf = pdf[pdf["ts_us"].notna()]
            behind = pdf["ts_us"].to_numpy(np.int64) <= (wm_us if wm_us > 0 else -(1 << 63))
            if behind.any():
                late.append(self._late_rows(key, pdf[behind]))
                pdf = pdf[~behind]
            if not len(pdf):
                continue
            held.append(self._arrived(pdf))
            n += len(pdf)
            first = int(pdf["ts_us"].min())
            least = first if least is None else min(least, first)
            if n >= STEP_ROWS:
                at = self._hold(_joined(held), parts, at)
                held, n = [], 0
        if held:
            at = self._hold(_joined(held), parts, at)
        if least is not None:
            self._write_dir(parts, live, at)
            self.handle.registerTimer(least // 1000 + 1)
        return iter(late)

    def _late_rows(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[[*self.keys, self.id_col]].reset_index(drop=True)
        out["ts_us"] = pdf["ts_us"].to_numpy(np.int64)
        for name in self.rolling_names:
            out[name] = np.nan
        for name in self.cumulative_names:
            out[name] = pd.array([None] * len(out), dtype="Int64")
        out["late"] = True
        out[self.nulls] = pdf[self.nulls].to_numpy()
        timed = self._timed(out)
        return timed[[c for c in timed.columns if c != self.nulls] + [self.nulls]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._emit(key, int(timerValues.getCurrentWatermarkInMs()) * 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """As for one key; a large shard comes in several calls."""
        parts, live, at = self._read_dir()
        w = initialState[initialState["kind"] == "w"]
        if len(w):
            columns = {c: pa.array(w[c], from_pandas=True) for c in self._who}
            columns |= {"us": w["us"].to_numpy(np.int64)} | {c: w[c].to_numpy(np.float64) for c in self._sums} | {c: w[c].to_numpy(np.int64) for c in self._nums}
            seed = pa.table(columns)
            tile = columns["us"] // self.tile_us
            for x in np.unique(tile).tolist():
                self._add_tile(x, seed.filter(pa.array(tile == x)), live)
        c = initialState[initialState["kind"] == "c"]
        if self.cumulative and len(c):
            columns = {n: pa.array(c[n], from_pandas=True) for n in self._who}
            self._add_counts(pa.table(columns | {n: c[n].fillna(0).to_numpy(np.int64) for n in self._runs}))
        self._write_dir(parts, live, at)

    # -- state -------------------------------------------------------------------
    def _read_dir(self) -> tuple[dict[int, tuple[int, int, int]], set[int], int]:
        got = self.dir.get()
        if got is None:
            return {}, set(), 0
        part, tile, n, least, live, at = got
        return {p: (t, m, u) for p, t, m, u in zip(part, tile, n, least)}, set(live), at

    def _write_dir(self, parts: dict, live: set, at: int) -> None:
        columns = [[int(v[i]) for v in parts.values()] for i in range(3)]
        self.dir.update(([int(p) for p in parts], *columns, sorted(int(x) for x in live), int(at)))

    def _arrived(self, pdf: pd.DataFrame) -> pa.Table:
        columns = {c: pa.array(pdf[c], from_pandas=True) for c in [*self._who, self.id_col]}
        columns["us"] = pa.array(pdf["ts_us"].to_numpy(np.int64))
        return pa.table(columns | {n: pdf[s].to_numpy(np.float64, na_value=np.nan) for n, s in zip(self._sums, self.signals)})

    def _hold(self, rows: pa.Table, parts: dict, at: int) -> int:
        """Rows into ``buf``: few as one part, many by tile."""
        us = rows["us"].to_numpy()
        tile = us // self.tile_us
        for x in [NO_TILE] if len(us) < PART_ROWS else np.unique(tile).tolist():
            some = rows if x == NO_TILE else rows.filter(pa.array(tile == x))
            self.buf.updateValue((at,), (_packed(some),))
            parts[at] = (x, some.num_rows, int(us.min() if x == NO_TILE else some["us"].to_numpy().min()))
            at += 1
        return at

    def _codes(self, tables: list[pa.Table]) -> list[np.ndarray]:
        """Equal numbers for equal keys over several tables."""
        own = (1 << len(self.keys)) - 1
        code = np.zeros(sum(t.num_rows for t in tables), np.int64)
        for c in self._who:
            if c == self.nulls:
                values = np.concatenate([t[c].to_numpy() for t in tables]) & own
            else:
                column = _joined([t.select([c]) for t in tables])[c].combine_chunks()
                if pa.types.is_null(column.type):
                    continue
                values = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
            _, code = np.unique(code * (int(values.max(initial=0)) + 1) + values, return_inverse=True)
        return np.split(code, np.cumsum([t.num_rows for t in tables])[:-1])

    def _reduced(self, t: pa.Table, timed: bool) -> pa.Table:
        """Sums and counts per key (and time)."""
        (code,) = self._codes([t])
        us = t["us"].to_numpy() if timed else np.zeros(t.num_rows, np.int64)
        order = np.lexsort((us, code))
        code, us = code[order], us[order]
        cuts = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(us) != 0)])
        out = {c: t[c].take(pa.array(order[cuts])) for c in self._who} | ({"us": us[cuts]} if timed else {})
        return pa.table(out | {c: np.add.reduceat(t[c].to_numpy()[order], cuts) for c in [*self._sums, *self._nums]})

    def _read(self, state, tile: int) -> pa.Table:
        return _unpacked(state.getValue((tile,))[0])

    def _add_tile(self, tile: int, entries: pa.Table, live: set) -> None:
        if tile in live:
            entries = _joined([self._read(self.tiles, tile), entries])
        entries = self._reduced(entries, timed=True)
        self.tiles.updateValue((tile,), (_packed(entries),))
        self.sums.updateValue((tile,), (_packed(self._reduced(entries, timed=False)),))
        live.add(tile)

    def _add_counts(self, more: pa.Table) -> None:
        got = self.counts.get()
        if got is not None:
            more = _joined([_unpacked(got[0]), more])
        (code,) = self._codes([more])
        _, first, code = np.unique(code, return_index=True, return_inverse=True)
        columns = {c: more[c].take(pa.array(first)) for c in self._who}
        for c in self._runs:
            total = np.zeros(len(first), np.int64)
            np.add.at(total, code, more[c].to_numpy())
            columns[c] = total
        self.counts.update((_packed(pa.table(columns)),))

    # -- the fold -------------------------------------------------------------------
    def _emit(self, key, wm_us: int) -> Iterator[pd.DataFrame]:
        parts, live, at = self._read_dir()
        due = {p: v for p, v in parts.items() if v[2] <= wm_us}
        if not due:
            return
        loose, loose_tile = None, np.zeros(0, np.int64)
        if mixed := [p for p, v in due.items() if v[0] == NO_TILE]:
            loose = _joined([self._read(self.buf, p) for p in mixed])
            loose_tile = loose["us"].to_numpy() // self.tile_us
        by_tile: dict[int, list[int]] = {}
        for p, v in due.items():
            if v[0] != NO_TILE:
                by_tile.setdefault(v[0], []).append(p)
        weight = dict(zip(*(x.tolist() for x in np.unique(loose_tile, return_counts=True))))
        for x, some in by_tile.items():
            weight[x] = weight.get(x, 0) + sum(parts[p][1] for p in some)
        step, rows, rest = [], 0, []
        tiles = sorted(weight)
        for i, x in enumerate(tiles):
            step.append(x)
            rows += weight[x]
            if rows < STEP_ROWS and i + 1 < len(tiles):
                continue
            taken = [self._read(self.buf, p) for y in step for p in by_tile.get(y, ())]
            if loose is not None:
                taken.append(loose.filter(pa.array((loose_tile >= step[0]) & (loose_tile <= x))))
            taken = _joined(taken)
            ready = taken["us"].to_numpy() <= wm_us
            rest.append(taken.filter(pa.array(~ready)))
            # Later events come after the watermark, or in the tiles of the next step.
            upto = min(wm_us, (x + 1) * self.tile_us - 1) if i + 1 < len(tiles) else wm_us
            if ready.any():
                yield self._fold(taken.filter(pa.array(ready)), live, upto - self.window_us)
            step, rows = [], 0
        for p in due:
            self.buf.removeKey((p,))
            del parts[p]
        rest = _joined(rest)
        if rest.num_rows:
            at = self._hold(rest, parts, at)
        self._write_dir(parts, live, at)
        if parts:
            self.handle.registerTimer(min(v[2] for v in parts.values()) // 1000 + 1)

    def _fold(self, ready: pa.Table, live: set, from_us: int) -> pd.DataFrame:
        """Features of ``ready``, whose tiles join ``live``; tiles that end by ``from_us`` go."""
        k, t = len(self.signals), ready["us"].to_numpy()
        given = np.column_stack([ready[c].to_numpy() for c in self._sums]) if k else np.zeros((len(t), 0))
        known = ~np.isnan(given)
        value = np.where(known, given, 0.0)
        columns = {c: ready[c] for c in [*self._who, "us"]}
        columns |= {c: value[:, i] for i, c in enumerate(self._sums)} | {c: known[:, i].astype(np.int64) for i, c in enumerate(self._nums)}
        fresh = pa.table(columns)

        # As for one key: tiles cut by some window's edge, or that gain events, by entry,
        # the others in a window by their totals.
        tile = t // self.tile_us
        gains = np.unique(tile).tolist()
        cut = {int(x) for x in np.unique((t - self.window_us) // self.tile_us)} | set(gains)
        seen = [x for x in live if int(t.min()) - self.window_us < (x + 1) * self.tile_us and x <= gains[-1]]
        past = [self._read(self.tiles, x) for x in seen if x in cut]
        for x in seen:
            if x not in cut:
                total = self._read(self.sums, x)
                past.append(total.append_column("us", pa.array(np.full(total.num_rows, x * self.tile_us))))
        entries = _joined([p.select(fresh.column_names) for p in [fresh, *past]])
        counts = self.counts.get() if self.cumulative else None
        counts = _unpacked(counts[0]) if counts is not None else fresh.slice(0, 0)
        code, of_counts = self._codes([entries, counts])
        mine = code[: len(t)]
        us = entries["us"].to_numpy()
        times = np.unique(us)
        place = code * (len(times) + 1) + np.searchsorted(times, us)
        order = np.argsort(place, kind="stable")
        place, by_code = place[order], code[order]
        lo = np.searchsorted(place, mine * (len(times) + 1) + np.searchsorted(times, t - self.window_us))
        hi = np.searchsorted(place, mine * (len(times) + 1) + np.searchsorted(times, t))  # tied peers and the event itself excluded
        out = {c: ready[c].to_pandas() for c in [*self.keys, self.id_col]} | {"ts_us": t}
        for i, name in enumerate(self.rolling_names):
            n = np.r_[0, np.cumsum(entries[self._nums[i]].to_numpy()[order])]
            number = n[hi] - n[lo]
            total = _between(entries[self._sums[i]].to_numpy()[order], by_code, lo, hi)
            out[name] = np.where(number > 0, total / np.maximum(number, 1), np.nan)
        if self.cumulative:
            at = np.argsort(mine * (len(times) + 1) + np.searchsorted(times, t), kind="stable")
            first = np.searchsorted(mine[at], mine)
            tied = np.searchsorted((mine * (len(times) + 1) + np.searchsorted(times, t))[at], mine * (len(times) + 1) + np.searchsorted(times, t))
            for j, name in enumerate(self.cumulative_names):
                run = np.r_[0, np.cumsum(value[:, self._cum_idx[j]].astype(np.int64)[at])]
                before = np.zeros(int(code.max(initial=0)) + 1 + len(of_counts), np.int64)
                if counts.num_rows:
                    before[of_counts] = counts[self._runs[j]].to_numpy()
                out[name] = before[mine] + run[tied] - run[first]
            own = {c: ready[c] for c in self._who} | {c: value[:, self._cum_idx[j]].astype(np.int64) for j, c in enumerate(self._runs)}
            self._add_counts(pa.table(own))

        for x in [x for x in live if (x + 1) * self.tile_us <= from_us]:
            self.tiles.removeKey((x,))
            self.sums.removeKey((x,))
            live.discard(x)
        for x in gains:
            if (x + 1) * self.tile_us > from_us:
                self._add_tile(x, fresh.filter(pa.array(tile == x)), live)
        timed = self._timed(pd.DataFrame(out | {"late": False}))
        timed[self.nulls] = ready[self.nulls].to_numpy()
        return timed


def _between(s: np.ndarray, group: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``s[lo:hi]``, ranges inside one group each; groups stand together. Whole
    numbers go through one running sum, others through one per group, so that no group's
    values reach another's."""
    if not len(s) or (np.abs(s).sum() < 2**53 and (s == np.floor(s)).all()):
        run = np.r_[0.0, np.cumsum(s)]
        return run[hi] - run[lo]
    starts = np.flatnonzero(np.r_[True, np.diff(group) != 0])
    run = np.zeros(len(s) + len(starts))  # one zero before each group
    for i, (a, b) in enumerate(zip(starts, np.r_[starts[1:], len(s)])):
        run[a + i + 1 : b + i + 1] = np.cumsum(s[a:b])
    # ``lo`` is in the group of its range unless that is empty.
    shift = np.searchsorted(starts, np.minimum(lo, len(s) - 1), side="right") - 1
    return np.where(hi > lo, run[hi + shift] - run[lo + shift], 0.0)


def _joined(tables: list[pa.Table]) -> pa.Table:
    """Tables one after the other; a column of nulls only takes the others' type."""
    return pa.concat_tables(tables, promote_options="permissive")


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(blob) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(blob))).read_all()


class _Tiles:
    """Events as (times, sums, counts) with distinct ascending times."""

    @staticmethod
    def merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts together, entries of one time added up."""
        us = np.concatenate([p[0] for p in parts])
        s, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        times, at = np.unique(us, return_inverse=True)
        sums, nums = np.zeros((len(times), s.shape[1])), np.zeros((len(times), s.shape[1]), np.int64)
        np.add.at(sums, at, s)
        np.add.at(nums, at, n)
        return times, sums, nums

    @staticmethod
    def of(us: np.ndarray, s: np.ndarray, n: np.ndarray, tile_us: int) -> dict:
        """By tile."""
        if not len(us):
            return {}
        us, s, n = _Tiles.merged([(us, s, n)])
        tile = us // tile_us
        cuts = np.flatnonzero(np.diff(tile)) + 1
        split = zip(np.split(us, cuts), np.split(s, cuts), np.split(n, cuts))
        return {int(x[0] // tile_us): (x, a, b) for x, a, b in split}


def _nulled(column: pd.Series, kind: type) -> list:
    """Python values, nulls and NaN as None."""
    gone = column.isna().to_numpy()
    if not gone.any():
        return column.astype("int64" if kind is int else "float64").tolist()
    return [None if g else kind(v) for v, g in zip(column.tolist(), gone)]
