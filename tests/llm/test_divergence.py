import re
from collections import Counter, defaultdict

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import divergence, queries
from tools_compare import same_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top=10):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows, from the definition."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOW))
        count[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in count}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in count.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in groups:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def run(df, **more):
    return sorted(map(tuple, divergence.audit(df, **more).collect()))


def test_query_equals_sql(spark, duck):
    df = queries.op11_source_divergence(spark, SF_SMALL)
    rel = duck.execute(divergence.SQL)
    ok, why = same_rows(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in rel.description], rel.fetchall())
    assert ok, why


def test_edges(spark, nasty, no_docs):
    rows = [(r.lang, r.source, r.text) for r in nasty.collect()]
    assert run(nasty, min_docs=2) == brute(rows, 2)
    assert run(no_docs) == []
    rows = [("en", "a", "One two, TWO three"), ("en", "b", "one-two\x00four"), ("en", None, None), ("en", "c", "9 9 9"),
            (None, "a", "é É one"), (None, "b", ""), ("fr", "only", "un deux"), ("en", "a", "One two, TWO three")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n long, term string")
    for least in (1, 2, 9):
        assert run(df, min_docs=least) == brute(rows, least)


def test_long_text_and_many_sources(spark, monkeypatch):
    rows = [("en", f"s{i % 300}", f"common word{i % 7} rare{i % 50} s{i % 300}") for i in range(900)]
    rows += [("en", "long", "common word1 " * 120_000 + "x" * 200_000)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert run(df, min_docs=2) == brute(rows, 2)


def test_small_tables_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", 2)
    monkeypatch.setattr(divergence, "BLOCK", 3)
    rows = [(f"l{i % 2}", f"s{i % 5}", " ".join(f"t{'abcdefghijk'[(i * j) % 11]}" for j in range(i % 9))) for i in range(60)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert run(df, min_docs=2) == brute(rows, 2)


def test_pieces_cut_no_word(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = b"Abc def\xc3\xa9 ghijklmnopqrs 12t"
    assert [t for piece in divergence.tokens(text) for t in piece] == [b"abc", "defé".encode(), b"ghijklmnopqrs", b"t"]


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "HELD", 3)
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 4, "source": ["s"] * 4, "text": ["x y", "z w x", "x x", "v"]})
    parts = [b.to_pylist() for b in divergence._count(iter([batch]))]
    assert len(parts) == 2
    total = Counter()
    for row in sum(parts, []):
        total[row["term"]] += row["n"]
    assert total == Counter("x y z w x x x v".split())
