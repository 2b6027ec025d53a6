"""The first 64 bits of MurmurHash3 x64 128 with seed 0, after its published description."""

from __future__ import annotations

import functools

MASK = (1 << 64) - 1
#: Fixed values of the published algorithm.
C1, C2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
MIX1, MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def _turn(x: int, by: int) -> int:
    return ((x << by) | (x >> (64 - by))) & MASK


def _finish(x: int) -> int:
    for factor in (MIX1, MIX2):
        x = ((x ^ (x >> 33)) * factor) & MASK
    return x ^ (x >> 33)


def h1(data: bytes) -> int:
    lanes = [0, 0]
    # (multipliers, turn of the input, turn of the lane, added constant)
    steps = (((C1, C2), 31, 27, 0x52DCE729), ((C2, C1), 33, 31, 0x38495AB5))

    def scrambled(word: int, lane: int) -> int:
        (first, second), turn, _, _ = steps[lane]
        return (_turn((word * first) & MASK, turn) * second) & MASK

    whole = len(data) // 16 * 16
    for at in range(0, whole, 16):
        for lane in (0, 1):
            _, _, turn, plus = steps[lane]
            word = int.from_bytes(data[at + 8 * lane : at + 8 * lane + 8], "little")
            lanes[lane] ^= scrambled(word, lane)
            lanes[lane] = ((_turn(lanes[lane], turn) + lanes[1 - lane]) * 5 + plus) & MASK
    for lane in (1, 0):
        if rest := data[whole + 8 * lane :][:8]:
            lanes[lane] ^= scrambled(int.from_bytes(rest, "little"), lane)
    a, b = (x ^ len(data) for x in lanes)
    a = (a + b) & MASK
    b = (b + a) & MASK
    return (_finish(a) + _finish(b)) & MASK


@functools.lru_cache(65_536)
def bucket(key: str, buckets: int) -> int:
    return h1(key.encode("utf-8", "replace")) % buckets
