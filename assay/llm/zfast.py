"""Z-fast trie over sequences given by the fingerprints of their prefixes.

The trie is compacted: a node stands where sequences part or one ends, and its edge covers
the depths from its parent's (exclusive) to its own.  Every node is filed in a hash table
under the fingerprint of one prefix on its edge, its handle: the one whose length is the
two-fattest number of the edge (the number with the most trailing zero bits).  The place
where a new sequence leaves the trie is found by fat binary search: probe the two-fattest
length of the open interval, go below it if a node whose whole path is a prefix of the
sequence is filed there, else above it; that takes the logarithm of the length in probes.
"""

from __future__ import annotations


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] with the most trailing zero bits."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Node:
    """A compacted node; ``path`` holds the prefix fingerprints of a sequence through it
    (``path[d]`` for depth d of this trie), ``sizes[d - 1]`` what its d-th symbol weighs."""

    __slots__ = ("depth", "path", "sizes", "kids", "ends", "n", "least")

    def __init__(self, depth: int, path: list, sizes: list):
        self.depth, self.path, self.sizes = depth, path, sizes
        self.kids: dict = {}            # fingerprint one below this depth -> node
        self.ends = 0                   # members that end here
        self.n = 0                      # members that pass or end here
        self.least = None               # smallest member


class ZFastTrie:
    def __init__(self, root_fingerprint):
        self.root = Node(0, [root_fingerprint], [])
        self.handles: dict = {}
        self.probes = 0

    def locate(self, path: list) -> Node:
        """The deepest node whose whole path is a prefix of the sequence."""
        node, a, b = self.root, 0, len(path) - 1
        while a < b:
            at = two_fattest(a, b)
            self.probes += 1
            hit = self.handles.get(path[at])
            if hit is not None and hit.depth < len(path) and hit.path[hit.depth] == path[hit.depth]:
                node, a = hit, hit.depth
            else:
                b = at - 1
        return node

    def _file(self, node: Node, top: int) -> None:
        self.handles[node.path[two_fattest(top, node.depth)]] = node

    def _hang(self, above: Node, node: Node) -> None:
        above.kids[node.path[above.depth + 1]] = node
        self._file(node, above.depth)

    def insert(self, path: list, sizes: list, count: int, least) -> None:
        """Add ``count`` members with this sequence, ``least`` the smallest of them."""
        last, node = len(path) - 1, self.locate(path)
        if node.depth < last:
            below = node.kids.get(path[node.depth + 1])
            if below is not None:       # the sequence leaves inside this edge: cut it there
                lo, hi = node.depth + 1, min(last, below.depth)
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    if below.path[mid] == path[mid]:
                        lo = mid
                    else:
                        hi = mid - 1
                fork = Node(lo, below.path, below.sizes)
                del self.handles[below.path[two_fattest(node.depth, below.depth)]]
                self._hang(node, fork)
                self._hang(fork, below)
                node = fork
            if node.depth < last:
                leaf = Node(last, path, sizes)
                self._hang(node, leaf)
                node = leaf
        node.ends += count
        node.n += count
        node.least = least if node.least is None else min(least, node.least)

    def insert_batch(self, batch) -> None:
        """Add ``(path, sizes, member)`` triples; equal sequences are located once."""
        equal: dict = {}
        for path, sizes, member in batch:
            got = equal.get((len(path), path[-1]))
            if got is None:
                equal[len(path), path[-1]] = [path, sizes, 1, member]
            else:
                got[2] += 1
                got[3] = min(got[3], member)
        for path, sizes, count, least in equal.values():
            self.insert(path, sizes, count, least)

    def expand(self):
        """``(depth, fingerprint, parent's position, size, members, smallest member, ends)``
        of every node of the full trie, parents first; positions count the yielded nodes."""
        order, stack = [], [(self.root, None)]
        while stack:
            node, above = stack.pop()
            order.append((node, above))
            stack += [(kid, node) for kid in node.kids.values()]
        n, least = {}, {}
        for node, above in reversed(order):
            n[node] = n.get(node, 0) + node.n
            low = least.get(node)
            low = node.least if low is None else low if node.least is None else min(low, node.least)
            least[node] = low
            if above is not None:
                n[above] = n.get(above, 0) + n[node]
                if low is not None and (least.get(above) is None or low < least[above]):
                    least[above] = low
        position, at = {}, 0
        for node, above in order:
            up = -1 if above is None else position[above]
            for d in range(0 if above is None else above.depth + 1, node.depth + 1):
                yield d, node.path[d], up, node.sizes[d - 1] if d else 0, n[node], least[node], \
                    node.ends if d == node.depth else 0
                up, at = at, at + 1
            position[node] = up
