"""The number of keys that linked sets share at least, over sets with unequal numbers of empty blocks."""

import numpy as np

from trivet.llm import setjoin


def in_blocks(rng, at, blocks):
    """A hash in each of the blocks at."""
    width = 2**32 // blocks
    return [(int(b) * 2**32 // blocks + 1 + int(rng.integers(0, width - 2))) << 32 | int(rng.integers(0, 2**32)) for b in at]


def test_least_shared_is_a_lower_bound():
    rng = np.random.default_rng(7)
    # Eight shingles in three of seven blocks, and two more in empty ones: three keys are shared.
    a = in_blocks(rng, [0, 0, 0, 1, 1, 1, 2, 2], 7)
    pairs = [(a, [*a, *in_blocks(rng, [4, 5], 7)], 80)]
    for num in (80, 85):
        for _ in range(3000):
            n = int(rng.integers(4, 120))
            _, _, high = setjoin._size_class(n, num, 100)
            blocks = (100 - num) * 2 * high // (100 + num)
            blocks += 1 + 2 + int(np.ceil(0.04 * blocks))
            some = rng.choice(blocks, int(rng.integers(1, blocks + 1)), replace=False)
            a = in_blocks(rng, rng.choice(some, n), blocks)
            less = int(rng.integers(0, max(1, n // 8)))
            pairs.append((a, [*a[less:], *in_blocks(rng, rng.integers(0, blocks, int(rng.integers(0, max(2, n // 4)))), blocks)], num))
    linked = uneven = 0
    for a, b, num in pairs:
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        both = len(np.intersect1d(a, b))
        if 100 * both >= num * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            shared = len(np.intersect1d(setjoin.sub_vectors(a, num, 100), setjoin.sub_vectors(b, num, 100)))
            needs = [setjoin.least_shared(x, num, 100) for x in (a, b)]
            assert 1 <= min(needs) and max(needs) <= shared
            linked += 1
            uneven += needs[0] != needs[1]
    assert linked > 1000 and uneven > 100
