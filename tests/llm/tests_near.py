"""Near-duplicate classes by comparing all pairs."""


def classes(own):
    sets = {}
    for k, t in own.items():
        w = (t or "").encode().split()
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    low = {k: k for k in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}
