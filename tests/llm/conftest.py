import random

import pytest


@pytest.fixture(scope="session")
def numbered_texts():
    """(id, text, slot) with exact and near copies, shared passages, repeats, nulls, empty and long texts."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(300)]
    passage = [r.choice(words) for _ in range(45)]
    texts = []
    for i in range(120):
        own = [r.choice(words) for _ in range(r.choice([3, 19, 20, 21, 60, 150]))]
        if i % 4 == 0:
            at = r.randint(0, len(own))
            own[at:at] = passage[r.randint(0, 20) :]
        if i % 7 == 0 and i:
            own = texts[i // 2].split() if texts[i // 2] else own
        if i % 14 == 0 and len(own) > 30:
            own = [*own[:-1], "changed"]
        texts.append(r.choice([" ", "  ", "\n"]).join(own))
    texts[5], texts[6], texts[7] = None, "", " \t "
    texts[8] = " ".join(["loop"] * 400)
    texts[9] = " ".join(r.choice(words) for _ in range(20_000)) + " " + " ".join(passage)
    return [(i, t, i % 3) for i, t in enumerate(texts)]
