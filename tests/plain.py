"""Plain-Python models of the rules, for comparison on small inputs."""

from collections import deque


def strip_chars():
    return {chr(i) for i in range(0x110000) if chr(i).isspace()}


def best_cut(text, limit, marks):
    """Length kept by the first mark whose last place lies in the second half, else None."""
    head = text[:limit]
    for mark in marks:
        places = [i for i in range(len(head)) if head.startswith(mark, i)]
        if places and places[-1] > limit // 2:
            return places[-1] + len(mark)
    return None


def summary(text):
    if len(text) <= 300:
        return text.strip()
    kept = best_cut(text, 300, [". ", "。", "! ", "? ", "\n"])
    return text[:300 if kept is None else kept].strip() + "…"


def short_summary(title, body):
    if not body or len(body) <= 200:
        return body or title.strip()
    cuts = [c - len(m) + 1 for m in (". ", "。", "! ") if (c := best_cut(body, 200, [m])) is not None]
    return body[:max(cuts)].strip() if cuts else body[:200].strip() + "…"


def ttl_kept(seconds, ttl):
    """Indexes kept of a sorted list."""
    kept = []
    for i, s in enumerate(seconds):
        if not kept or s - seconds[kept[-1]] > ttl:
            kept.append(i)
    return kept


def window_kept(keys, size):
    window, kept = deque(maxlen=size), []
    for i, key in enumerate(keys):
        if key not in window:
            window.append(key)
            kept.append(i)
    return kept


def backfill(rows, per_feed, total, cutoff):
    """rows: (feed, pos, published_ts) in order. Returns published rows and counters per feed."""
    published, counters = [], {}
    for feed in sorted({r[0] for r in rows}):
        count = counters[feed] = {"published": 0, "skip_old": 0, "skip_per_feed_limit": 0}
        for row in (r for r in rows if r[0] == feed):
            if cutoff is not None and row[2] is not None and row[2] < cutoff:
                count["skip_old"] += 1
            elif per_feed is not None and count["published"] >= per_feed:
                count["skip_per_feed_limit"] += 1
            elif total is not None and len(published) >= total:
                return published, counters
            else:
                count["published"] += 1
                published.append(row)
    return published, counters
