"""Exact quantiles and order statistics without sorting the table.

The wanted ranks are bracketed with ``approx_percentile`` (bounded sketches, merged
map-side), the rows inside each bracket are counted, and the bracket shrinks by about the
sketch accuracy per round until what is left fits a small buffer, whose bound all targets
share. Every round is one scan-and-aggregate for all columns; the result is exact, and
tables of every size take the same way.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUFFER_ROWS = 50_000
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], buffer_rows: int = BUFFER_ROWS
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; NULL and NaN are ignored."""
    clean = df.select([_finite(c).alias(c) for c in columns])
    counts = clean.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    places = {(c, p): p * (counts[c] - 1) for c in columns if counts[c] for p in probs}
    wanted = {(c, side(place)): True for (c, _), place in places.items() for side in (math.floor, math.ceil)}
    values = order_statistics(clean, {c: F.col(c) for c in columns}, list(wanted), counts, buffer_rows)

    def quantile(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        place = places[c, p]
        low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))

    return {c: [quantile(c, p) for p in probs] for c in columns}


def order_statistics(
    df: DataFrame,
    exprs: Mapping[str, Column],
    targets: Sequence[tuple[str, int]],
    counts: Mapping[str, int],
    buffer_rows: int = BUFFER_ROWS,
) -> dict[tuple[str, int], float]:
    """Exact k-th smallest (0-based) numbers; ``targets`` lists (expression, k)."""
    data = df.select([e.alias(n) for n, e in exprs.items()])
    # Per target: open value bounds, rows at or below the lower one, rows strictly inside.
    state = {t: (None, None, 0, counts[t[0]]) for t in targets}
    done: dict[tuple[str, int], float] = {}
    while state:
        # Targets inside the same bounds share one sketch or one buffer.
        shared: dict[tuple, list[int]] = {}
        for (c, k), (low, high, below, inside) in state.items():
            shared.setdefault((c, low, high, below, inside), []).append(k)
        sketches, slack, room = [], 2.0 / ACCURACY, buffer_rows // len(shared)
        for i, ((c, low, high, below, inside), ranks) in enumerate(shared.items()):
            held = F.when(_inside(c, low, high), F.col(c))
            if inside <= room:
                sketches.append(F.sort_array(F.collect_list(held)).alias(f"t{i}"))
                continue
            shares = [(k - below + 0.5) / inside for k in ranks]
            edges = [e for s in shares for e in (max(0.0, s - slack), min(1.0, s + slack))]
            sketches.append(F.percentile_approx(held, edges, ACCURACY).alias(f"t{i}"))
        found = data.agg(*sketches).first()
        brackets = {}
        for i, ((c, _, _, below, inside), ranks) in enumerate(shared.items()):
            for n, k in enumerate(ranks):
                if inside <= room:
                    done[c, k] = found[f"t{i}"][k - below]
                    del state[c, k]
                else:
                    brackets[c, k] = tuple(found[f"t{i}"][2 * n : 2 * n + 2])
        if not brackets:
            continue
        checks = []
        for i, ((c, k), (a, b)) in enumerate(brackets.items()):
            low, high, _, _ = state[c, k]
            x = F.col(c)
            checks += [
                F.count_if(_inside(c, low, high) & (x < F.lit(a))).alias(f"left{i}"),
                F.count_if(x == F.lit(a)).alias(f"at_a{i}"),
                F.count_if((x > F.lit(a)) & (x < F.lit(b))).alias(f"mid{i}"),
                F.count_if((x == F.lit(b)) & F.lit(a != b)).alias(f"at_b{i}"),
            ]
        seen = data.agg(*checks).first()
        for i, ((c, k), (a, b)) in enumerate(brackets.items()):
            low, high, below, inside = state[c, k]
            steps = [seen[f"{part}{i}"] for part in ("left", "at_a", "mid", "at_b")]
            upto = [below + sum(steps[: n + 1]) for n in range(4)]
            if k < upto[0]:
                state[c, k] = (low, a, below, steps[0])
            elif k < upto[1]:
                done[c, k] = a
                del state[c, k]
            elif k < upto[2]:
                state[c, k] = (a, b, upto[1], steps[2])
            elif k < upto[3]:
                done[c, k] = b
                del state[c, k]
            else:
                state[c, k] = (b, high, upto[3], inside - sum(steps))
    return done


def _inside(column: str, low, high) -> Column:
    cond = F.col(column).isNotNull()
    if low is not None:
        cond = cond & (F.col(column) > F.lit(low))
    if high is not None:
        cond = cond & (F.col(column) < F.lit(high))
    return cond


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)
