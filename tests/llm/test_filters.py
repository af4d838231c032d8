import numpy as np
import pytest

from cratewise.llm.filters import Packing, combined, read, write


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("bits", [1, 2, 7, 12, 13, 16, 17, 21, 25, 32])
def test_packing_and_filters_lose_nothing(n, bits):
    random = np.random.default_rng(n * 100 + bits)
    packing = Packing(n, bits)
    ids = [random.integers(0, 1 << bits, 3000) for _ in range(n)]
    ids = [np.concatenate([x, x[:500], [0, (1 << bits) - 1]]) for x in ids]
    counts = random.choice([1, 2, 254, 255, 256, 1 << 40], len(ids[0]))
    truth = {}
    for gram, count in zip(zip(*[x.tolist() for x in ids]), counts.tolist()):
        truth[gram] = truth.get(gram, 0) + count
    limbs = packing.keys(ids)
    assert [x.tolist() for x in packing.ids(limbs)] == [x.tolist() for x in ids]
    keys, sums = combined(limbs, counts)
    assert dict(zip(zip(*[x.tolist() for x in packing.ids(keys)]), sums.tolist())) == truth
    for range_bits in (0, 1, 4):
        range_bits = min(range_bits, packing.widths[0])
        ranges = packing.top(keys[0], range_bits) if range_bits else np.zeros(len(sums), np.uint64)
        got = {}
        for r in np.unique(ranges).tolist():
            of = ranges == r
            row = write(packing, [x[of] for x in keys], sums[of], range_bits)
            back, n_back = read(packing, row, int(r), range_bits)
            assert all((a == b[of]).all() for a, b in zip(back, keys))
            got.update(zip(zip(*[x.tolist() for x in packing.ids(back)]), n_back.tolist()))
        assert got == truth


def test_keys_that_share_the_first_limb_stay_apart():
    first = np.array([7, 7, 7, 7], np.uint64)
    second = np.array([1, 2, 1, 2], np.uint64)
    limbs, counts = combined([first, second], np.array([1, 10, 100, 1000]))
    assert limbs[1].tolist() == [1, 2] and counts.tolist() == [101, 1010]


def test_quotients_spread_neighbouring_ids():
    packing = Packing(2, 20)
    grid = np.divmod(np.arange(1 << 16), 256)
    top = packing.top(packing.keys([grid[0], grid[1]])[0], 6)
    share = np.bincount(top.astype(int), minlength=64) / (1 << 10)
    assert share.min() > 0.7 and share.max() < 1.3


def test_empty_filter():
    packing = Packing(3, 20)
    none = [np.zeros(0, np.uint64)]
    limbs, counts = combined(none, np.zeros(0, np.int64))
    row = write(packing, limbs, counts, 2)
    assert len(read(packing, row, 0, 2)[1]) == 0


def test_ids_beyond_32_bits_are_refused():
    with pytest.raises(ValueError):
        Packing(2, 33)
