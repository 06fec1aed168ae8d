import numpy as np

from quayside.llm import wordhash
from quayside.llm.wordhash import BASES, Words, mix


def value(word: bytes, base: int) -> int:
    total = 0
    for byte in reversed(word):
        total = (total * base + byte + 1) % (1 << 64)
    return int(mix(np.array([total], dtype=np.uint64))[0])


def test_words_of_any_length_without_large_tables():
    r = np.random.default_rng(1)
    sizes = [1, 40, 70_000, (1 << 18) - 1, 1 << 18, (1 << 18) + 1, 600_000, 3]
    words = [r.integers(33, 127, size, dtype=np.uint8).tobytes() for size in sizes]
    data = np.frombuffer(b" ".join(words), np.uint8)
    for which, (base, _) in enumerate(BASES):
        got = Words(data, np.array([0, len(data)])).hashes(which)
        assert got.tolist() == [value(w, int(base)) for w in words]
    assert max(len(row) for row, _ in wordhash._powers.values()) <= 1 << 19
