"""Small documents with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, fp string, row string, part string, rank string, label string, score string"
LINE = "Released under the MIT License."


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(words) + (".\n" if i % 13 == 12 else ", " if i % 7 == 3 else " "))
    return "".join(out).strip()


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnoprstué") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts: list[str | None] = [prose(rng, rng.randint(1, 120), words) for _ in range(n)]
    texts += [texts[0]] * 7  # copies
    texts += [texts[1] + " x", texts[1] + " y"]
    texts += [None, "", " ", "\n\n", "a", "  a \t b\n\n c  ", "x" * 20_000, prose(rng, 6000, words)]
    texts += ["don't WE'LL <|endoftext|>x <|startoftext|> é́a \x1c\x85　日本語 😀👩‍👩‍👧 ﬁ Ⅷ ½ İ ΣΑΣ ς", "ünï çødé " * 40]
    texts += [f"password = 'abcdef12' and AKIA{'A1' * 9} {'0af' * 9} Token:xyz secret=token: abcdefgh ghp_{'a' * 36}"]
    texts += [f"{texts[2]}\n{LINE}", "Licensed under the Apache License, Version 2.0. CC BY-NC 4.0; cc by nc, under the MIT license"]
    texts += ["Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"]
    texts += ["same words again and then once more " * 30, "\n".join(["a line that comes again"] * 12 + [texts[3]]), "### $$$ ||| &&& " * 20]
    out = [(i, t, "en" if i % 3 else None, f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    out += [out[5], out[5], (None, texts[4], "de", None, None), (None, None, None, None, None)]
    return [r + ("clash",) * 8 for r in out]
