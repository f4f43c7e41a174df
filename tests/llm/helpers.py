"""Small inputs with every oddity: NULLs, empty and long texts, repeated rows, columns whose names the operators use inside."""

from __future__ import annotations

import random

CLASHES = {"key": "long", "hash": "long", "pos": "int", "line": "string", "kind": "int", "print": "long", "score": "double", "n_removed": "int", "_key": "long", "_gone": "long",
           "_marks": "string", "spans": "string", "count": "long", "fold": "int", "held": "int", "bin": "long", "site": "string", "word": "string", "t": "string"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{k}` {v}" for k, v in CLASHES.items())
VALUES = {"long": 7, "int": 7, "string": "seven", "double": 7.0}
WORDS = {"en": "the of and to in that is was for with on as by at from".split(), "de": "der die und in den von zu das mit sich auf für ist im nicht".split(),
         "fr": "le de la et les des en un du une que est pour qui dans".split()}


def frame(spark, rows, parts: int = 3):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src", len(r[1]) if r[1] else None, *[VALUES[v] for v in CLASHES.values()]) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def prose(seed: int, words: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        w = rng.choice(WORDS[lang]) if rng.random() < 0.4 else "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou" if lang == "en" else "aeiouéü") for _ in range(rng.randint(1, 4)))
        out.append(w + rng.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out)


ODD = [(None, "no id at all"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "x"), (5, "same same"), (5, "same same"), (6, "é ü 漢字 𝒳   end"), (7, "a  b   c\n\n\nd \r\n\t e "),
       (8, "123 456"), (9, "<|endoftext|> mid <|endoftext|>"), (10, "nul \0 inside"), (11, prose(1, 30_000))]
