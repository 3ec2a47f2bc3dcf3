"""Brute-force helpers shared by the tests of this folder."""


def brute_components(ids, fps, radius):
    """Smallest id reachable over fingerprints at most ``radius`` bits apart."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least.get(root(i)) for i in range(len(ids))]
