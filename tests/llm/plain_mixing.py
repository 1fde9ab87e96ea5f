"""Targets and draws of the mix, one source after the other."""

import hashlib
import re


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(rows, weights=(5, 2, 1)):
    """{source: (size, target)}: shares over the limit are shared anew until none is above."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not full:
            out |= {s: level * weight[s] for s in free}
            break
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            free.discard(s)
    return {s: (sizes[s], out[s]) for s in order}


def copies(rows, seed=7):
    """How often each row of (doc_id, text, source) is drawn."""
    goal = targets(rows)
    mark = lambda d: hashlib.md5(f"{'null' if d is None else d}:{seed}".encode()).hexdigest()
    out = [0] * len(rows)
    for source, (total, target) in goal.items():
        if not total:
            continue
        times = int(target // total)
        rest, before = target - times * total, 0
        own = [i for i, r in enumerate(rows) if r[2] == source]
        for i in sorted(own, key=lambda i: (mark(rows[i][0]), size(rows[i][1]))):
            n = size(rows[i][1])
            out[i] = (times + (2 * before + n <= 2 * rest)) if n else 0
            before += n
    return out
