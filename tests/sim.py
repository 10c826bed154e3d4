"""Plain-Python sequential simulations of the reference's keyed rules.

They process one record at a time in arrival order, the way the
reference's functions do, and are the brute-force side of the tests.
"""

from collections import defaultdict
import heapq


def running_holdings(own):
    """own: [(nav_id, user_id, share, seq)] -> {(nav, user, seq): holding}."""
    h, out = defaultdict(int), {}
    for nav, user, share, seq in sorted(own, key=lambda r: r[3]):
        h[(nav, user)] += share
        out[(nav, user, seq)] = h[(nav, user)]
    return out


def _merged(own, nav):
    ev = [(seq, 1, "own", (n, u, s)) for n, u, s, seq in own]
    ev += [(seq, 0, "nav", (n, v)) for n, v, seq in nav]
    return sorted(ev)


def portfolio(own, nav):
    """-> sorted [(user, nav, unit_value, valuation, seq)] (map state per nav)."""
    state, out = defaultdict(dict), []
    for seq, _, kind, rec in _merged(own, nav):
        if kind == "own":
            n, u, s = rec
            state[n][u] = state[n].get(u, 0) + s
        else:
            n, v = rec
            out += [(u, n, v, v * h, seq) for u, h in state[n].items()]
    return sorted(out)


def lots(own, nav):
    """-> sorted [(nav, user, share, unit_value, valuation, nav_seq, lot_seq)]."""
    state, out = defaultdict(list), []
    for seq, _, kind, rec in _merged(own, nav):
        if kind == "own":
            n, u, s = rec
            state[n].append((u, s, seq))
        else:
            n, v = rec
            out += [(n, u, s, v, v * s, seq, q) for u, s, q in state[n]]
    return sorted(out)


def toggle(tx, ttl):
    """tx: [(key, ts, id)] -> sorted emitted [(key, ts, id)].

    Arrivals and timer firings in time order; at one instant arrivals
    come first (a partner exactly at the deadline is in time).
    """
    events = [(ts, 0, i, key) for key, ts, i in tx]
    heapq.heapify(events)
    open_, out = {}, []
    while events:
        t, kind, i, key = heapq.heappop(events)
        if kind == 0:
            if key in open_:
                del open_[key]
            else:
                open_[key] = (key, t, i)
                heapq.heappush(events, (t + ttl, 1, i, key))
        elif key in open_:
            out.append(open_[key])
    return sorted(out)


def clean(tx, ttl):
    """Timer cancelled on match, key cleared on emit."""
    by_key = defaultdict(list)
    for key, ts, i in tx:
        by_key[key].append((ts, i))
    out = []
    for key, rows in by_key.items():
        opened = None
        for ts, i in sorted(rows):
            if opened is not None and ts - opened[1] > ttl:
                out.append(opened)
                opened = None
            opened = (key, ts, i) if opened is None else None
        if opened is not None:
            out.append(opened)
    return sorted(out)


def sided(tx, ttl):
    """tx: [(key, ts, id, side)] -> sorted unmatched [(key, ts, id, side)]."""
    out = []
    for a in tx:
        if not any(b[0] == a[0] and b[3] != a[3] and abs(b[1] - a[1]) <= ttl for b in tx):
            out.append(a)
    return sorted(out)
