import math
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.quality_rules import COMMON_WORDS, SYMBOLS, keep_good, rate_quality, repeated_lines, repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=20))
def test_repeated_words(words):
    assert repeated_words([w.encode() for w in words]) == base(" ".join(words))[4]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a \n\t\r é", max_size=20))
def test_repeated_lines(text):
    assert repeated_lines(text.encode()) == base(text)[3]


def made_rows():
    rng = random.Random(9)
    rows = []
    for lang in ("en", "fr"):
        for _ in range(60):
            rare = ["".join(rng.choices("aeiounrstl", k=rng.randint(2, 9))) for _ in range(200)]
            words = [rng.choice(COMMON_WORDS[lang][:12]) if rng.random() < 0.35 else w for w in rare]
            rows.append((len(rows), " ".join(words) + ".", lang))
    junk = [w.upper() + "!!" for w in rows[0][1].split()]
    rows += [(900, " ".join(junk), "en"), (901, rows[0][1].replace(" ", " | "), "en"), (902, " ".join(w + "$$$" for w in rows[0][1].split()), None)]
    rows += [(903, None, "en"), (904, "", None), (905, "one two " * 100, "en"), (906, rows[1][1], None), (907, rows[1][1], "xx"), (907, rows[1][1], "xx")]
    return rows


def test_frame(spark):
    rows = made_rows()
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, kept boolean")
    out = rate_quality(df).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for doc_id, text, _ in rows:
        r = by_id[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(text)
        assert not (r["base_failed"] and r["kept"])
    assert all(by_id[i]["kept"] for i in range(120))
    assert not any(by_id[i]["kept"] for i in (900, 901, 902, 903, 904, 905))
    assert by_id[906]["kept"] and by_id[907]["kept"]
    assert by_id[904]["char_distance"] is None
    kept = keep_good(df)
    assert kept.columns == df.columns and kept.count() == 120 + 3
    assert rate_quality(df.limit(0)).count() == 0


def test_distance_equals_its_definition(spark):
    """The word distance, from references and histograms counted in plain Python."""
    rows = made_rows()[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bins = {w for words in COMMON_WORDS.values() for w in words}
    shares, means = {}, defaultdict(Counter)
    for doc_id, text, lang in rows:
        counts = Counter(w if w in bins else "" for w in text.lower().split())
        shares[doc_id] = {w: n / sum(counts.values()) for w, n in counts.items()}
        means[lang].update({w: int(n * 1_000_000 / sum(counts.values())) for w, n in counts.items()})
    for r in rate_quality(df).collect():
        total = sum(means[r["lang"]].values())
        q = {w: n / total for w, n in means[r["lang"]].items()}
        p = shares[r["doc_id"]]
        half = {w: (p.get(w, 0) + q.get(w, 0)) / 2 for w in {*p, *q}}
        parts = [x[w] * math.log2(x[w] / half[w]) for x in (p, q) for w in x if x[w] > 0]
        assert abs(r["word_distance"] - math.sqrt(sum(parts) / 2)) < 1e-6
