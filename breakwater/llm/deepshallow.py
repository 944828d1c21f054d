"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries for what still ties there."""

from __future__ import annotations

# Parameters: the depth to which multikey quicksort goes, the bytes it compares at a time.
SHALLOW, WORD = 40, 8

Sorted = list[tuple[bytes, int]]


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


class _Branch:
    """Strings below agree on the first ``depth`` bytes and part there; a string that ends parts at -1."""

    __slots__ = ("depth", "below")

    def __init__(self, depth: int):
        self.depth, self.below = depth, {}


def _byte(string: bytes, at: int) -> int:
    return string[at] if at < len(string) else -1


class BlindTrie:
    """A trie that keeps only the bytes where strings part: a string goes down blindly and is compared once."""

    def __init__(self, first: bytes):
        self.root: _Branch | bytes = first

    def add(self, string: bytes) -> None:
        at = self.root
        while isinstance(at, _Branch):
            at = at.below.get(_byte(string, at.depth)) or next(iter(at.below.values()))
        depth = shared(string, at)
        if depth == len(string) == len(at):
            return
        other, above, node = at, None, self.root
        while isinstance(node, _Branch) and node.depth < depth:
            above, node = node, node.below[_byte(string, node.depth)]
        if isinstance(node, _Branch) and node.depth == depth:
            node.below[_byte(string, depth)] = string
            return
        made = _Branch(depth)
        made.below = {_byte(other, depth): node, _byte(string, depth): string}
        if above is None:
            self.root = made
        else:
            above.below[_byte(string, above.depth)] = made

    def ordered(self) -> Sorted:
        """The strings in order, each with the length it shares with the one before; the first with none."""
        found, todo = [], [(self.root, 0)]
        while todo:
            node, lcp = todo.pop()
            if not isinstance(node, _Branch):
                found.append((node, lcp))
                continue
            first, *rest = sorted(node.below)
            todo.extend((node.below[b], node.depth) for b in reversed(rest))
            todo.append((node.below[first], lcp))
        return found


def deep_shallow(strings: list[bytes]) -> Sorted:
    """Distinct strings in rising order, each with the length of the prefix it shares with the one before (first: 0)."""
    runs: list[Sorted] = []
    todo = [(list(dict.fromkeys(strings)), 0)]
    while todo:
        own, depth = todo.pop()
        if len(own) < 2:
            if own:
                runs.append([(own[0], 0)])
            continue
        if depth >= SHALLOW:
            trie = BlindTrie(own[0])
            for string in own[1:]:
                trie.add(string)
            runs.append(trie.ordered())
            continue
        end = depth + WORD
        keys = [s[depth:end] for s in own]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less, same, more = [], [], []
        for key, string in zip(keys, own):
            (less if key < pivot else same if key == pivot else more).append(string)
        todo += [(more, depth), (same, end), (less, depth)]
    found: Sorted = []
    for run in runs:
        if found:
            run[0] = (run[0][0], shared(found[-1][0], run[0][0]))
        found += run
    return found
