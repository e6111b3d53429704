"""The source divergence audit against plain integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import divergence
from tests.llm import data

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id bigint, text string, lang string, source string"


def brute(rows, least=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(low)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for source in sources:
            whole.update(counts[lang, source])

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            term = [
                (t, (p[s][t] - q[t]) ** 2 // q[t])
                for t in kept
                if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                items = items[:top] if part == "term" else items
                out += [(lang, s, part, t, v, i + 1) for i, (t, v) in enumerate(items)]
    return sorted(out)


def table():
    rng = random.Random(13)
    rows = [(i, t, "en", "s") for i, t in data.edge_rows(rng)]
    for i in range(400):
        # A third of all rows are of one source, and some words are far more frequent.
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(9)}"
        text = data.prose(rng, rng.randrange(0, 60)) + " the The ÉTÉ the" * rng.randrange(4)
        rows.append((i, text, rng.choice(["en", "de"]), source))
    rows += [(1, "once", "lonely", "only"), (2, "never", "lonely", "other"), (3, "", "bare", "x")]
    rows += [(4, "same same", None, None)] * 3 + [(5, "same", None, "")] + [(6, "x9y", None, "z")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).selectExpr(
        "*", "1 AS n", "'x' AS term", "2L AS zero", "'y' AS `rank`"
    )


@pytest.mark.parametrize("tile, size", [(64, 1 << 14), (3, 50)])
def test_equals_plain_integers(spark, monkeypatch, tile, size):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "SLICE", size)
    rows = table()
    got = divergence.audit(frame(spark, rows).repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
    assert {r.part for r in got if r.lang == "lonely"} == {"pair"}


def test_other_limits(spark):
    rows = table()
    got = divergence.audit(frame(spark, rows), min_documents=1, top_terms=4).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 1, 4)


def test_counts_beyond_64_bits(spark):
    """Shares stay exact where a count times 10**9 does not fit 64 bits."""
    row = spark.range(1).selectExpr(
        "90000000000000 AS n", "100000000000000 AS total", "1000 AS vocabulary"
    )
    found = row.selectExpr(f"{divergence._share('n', 'total')} AS p").first().p
    assert found == 1 + 10**9 * (90000000000000 + 1) // (100000000000000 + 1000)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
