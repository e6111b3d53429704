"""Small tables for the tests of the text operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Columns beyond the contract, named like what operators use inside.
EXTRA = "node string, score string, part int, key string, features string, ids string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def prose(rng: random.Random, count: int) -> str:
    """Invented sentences."""
    parts = ["ba", "ne", "ri", "to", "shu", "mel", "ör", "é", "kan", "dol", "st", "wi"]
    out = []
    for i in range(count):
        word = "".join(rng.choices(parts, k=rng.randrange(1, 5)))
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            out[-1] += ".\n" if i % 27 == 26 else "."
    return " ".join(out).replace("\n ", "\n")


def edge_rows(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, repeated rows and ids, texts without words."""
    same = prose(rng, 80)
    return [
        (900, None),
        (901, ""),
        (None, prose(rng, 60)),
        (None, None),
        (902, prose(rng, 30_000)),
        (903, same),
        (903, same),
        (904, same),
        (905, "?! \n\t %%"),
        (906, "one"),
        (907, "x" * 5000),
        (908, "zu " * 4000),
        (909, "\u0000   🙂 日本語 <|endoftext|> a<|endoftext|>"),
    ]


def documents(spark, rows, extra: bool = True):
    frame = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS
    )
    if extra:
        for field in EXTRA.split(", "):
            name, kind = field.split()
            frame = frame.selectExpr("*", f"CAST(7 AS {kind}) AS {name}")
    return frame
