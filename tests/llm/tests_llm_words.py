"""Plain-Python words and shingles, for brute-force answers."""


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def lower(text):
    return (text or "").encode().lower().decode()


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
