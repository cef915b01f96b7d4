from collections import Counter

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import linededup, queries
from tools_compare import same_rows


def brute(rows, min_chars=10):
    low = str.maketrans(linededup.UPPER, linededup.LOWER)
    key = lambda x: x.strip(linededup.SPACE).translate(low)
    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(key(x)) < min_chars
                or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def run(df):
    return linededup.line_dedup(df).select("doc.doc_id", "kept", "n_lines", "n_dropped").collect()


def test_query_equals_sql(spark, duck):
    df = queries.op8_line_dedup(spark, SF_SMALL)
    rel = duck.execute(queries.OP8_SQL)
    ok, why = same_rows(df.columns, [tuple(r) for r in df.collect()],
                        [c[0] for c in rel.description], rel.fetchall())
    assert ok, why


def test_edges(nasty, no_docs):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    assert Counter(map(tuple, run(nasty))) == Counter(brute(rows))
    assert run(no_docs) == []


def test_many_copies_of_a_line(docs_of):
    rows = [(i, f"a very common line here\nown line number {i}\n  A VERY common line here\t") for i in range(300)]
    rows += [(9, "a repeated id with another text\nown line number 7")]
    assert Counter(map(tuple, run(docs_of(rows)))) == Counter(brute(rows))


def test_main_path_has_no_python(spark):
    plan = queries.op8_line_dedup(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
