"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, of: int = 400) -> str:
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


def awkward(seed: int = 1) -> list[tuple]:
    """Null, empty, blank and very long texts, copies, near copies, shared passages, repeated rows and a null id."""
    rng = random.Random(seed)
    base, passage = words(rng, 120), words(rng, 60, 10**6)
    texts = [None, "", "   \n\t", "one", "one two three four", "ÀÉ ça ñandú " * 9, base, base, base.replace("w1 ", "x1 "), base + " tail", base.upper()]
    texts += [words(rng, 80) + " " + passage + " " + words(rng, 70) for _ in range(12)]
    texts += [base.replace(f"w{k}", f"y{k}") for k in range(20, 32)]
    texts += [words(rng, 3000), "z" * 70_000, "ab " * 20_000, passage, passage + "\n" + passage]
    rows = [(k * 3 - 4, t, "en", "hot" if k % 3 == 0 else f"s{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    rows.append(rows[6])
    rows.append((None, base, None, None, None))
    return rows
