import re

import numpy as np
import pyarrow as pa

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import licenses, queries

TOK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    w = TOK.findall((text or "").translate(LOW))
    hits = [(i, lab) for p, lab in licenses.PHRASES.items() for i in range(len(w))
            if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({x for _, x in hits})))


def test_base_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries.op3_license_scan(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any(r.n_base for r in got) and SF_SMALL


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 4, n).tolist() for n in (30, 17, 40)]
    stream = rng.integers(0, 5, 400).tolist()
    auto = licenses.SuffixAutomaton(seqs, 3)
    runs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for i, (state, n) in enumerate(auto.statistics(stream)):
        want = max((k for k in range(i + 2) if k == 0 or tuple(stream[i - k + 1:i + 1]) in runs), default=0)
        assert n == want
        if n >= 3:
            ends = [(k, e) for k, s in enumerate(seqs) for e in range(n - 1, len(s))
                    if s[e - n + 1:e + 1] == stream[i - n + 1:i + 1]]
            assert set(ends) == set(auto.places[state])


def scan(*texts):
    return list(licenses.Scanner().scan(pa.array(texts, pa.string()), licenses.MIN_COVERAGE))


def test_full_and_broken_templates():
    by = dict(licenses.TEMPLATES[:5])
    whole = scan("intro words " + by["mit"].upper() + " more")[0]
    assert whole["labels"] == "mit" and whole["score"] == 1.0 and whole["n_base"] == 0
    words = by["bsd"].split()
    words[10] = "FOO"
    words[30:31] = ["some", "other"]
    broken = scan(" ".join(words))[0]
    assert broken["labels"] == "bsd" and 0.7 < broken["score"] < 1
    assert all(a["doc_word"] + a["words"] <= b["doc_word"] and a["template_word"] + a["words"] <= b["template_word"]
               for a, b in zip(broken["spans"], broken["spans"][1:]))
    shuffled = scan(" ".join(reversed(words)))[0]
    assert shuffled["labels"] == "" and shuffled["score"] == 0
    two = scan(by["mit"] + "\n\nxx " + by["apache"])[0]
    assert two["labels"] == "apache,mit" and two["base_labels"] == "apache"


def test_edges(nasty, no_docs, docs_of):
    rows = licenses.scan_licenses(nasty).collect()
    assert len(rows) == nasty.count()
    for r, d in zip(sorted(rows, key=str), sorted(rows, key=str)):
        assert r.score == 0 and r.labels == "" and r.first_word is None and r.spans == []
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 5)} == {0}
    assert licenses.scan_licenses(no_docs).count() == 0
    text = "MIT license mit LICENSE, cc-by cc by by"
    got = licenses.scan_licenses(docs_of([(1, text), (1, text)])).collect()
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels, r.score) for r in got] == [(4, 0, 6, "cc-by,mit", 1.0)] * 2


def test_parts_far_apart_and_stray_matches():
    words = dict(licenses.TEMPLATES)["mit"].split()
    n = len(words) // 3
    parts = [words[:n], words[n:2 * n], words[2 * n:]]
    other = [f"other{i}" for i in range(70)]
    far = scan(" ".join([*parts[0], *other, *parts[1], *other, *parts[2]]))[0]
    assert far["labels"] == "mit" and far["score"] == 1.0 and len(far["spans"]) == 3
    stray = scan(" ".join([*parts[0], "xx", *parts[2][-8:], "xx", *parts[1], "xx", *parts[2]]))[0]
    assert stray["labels"] == "mit" and stray["score"] == 1.0


def test_best_chain_equals_brute_force():
    rng = np.random.default_rng(6)
    names = [f"n{i}" for i in range(5)]
    templates = [(f"t{k}", " ".join(rng.choice(names, n))) for k, n in enumerate((25, 40, 12))]
    templates.append(("inner", " ".join(templates[1][1].split()[5:17])))  # lies within another one
    scanner = licenses.Scanner(templates, 4)
    seqs = [t.split() for _, t in templates]
    for _ in range(60):
        doc = []
        while len(doc) < 90:
            s = seqs[rng.integers(len(seqs))]
            i = rng.integers(len(s))
            doc += s[i:i + rng.integers(2, 14)] + (["out"] if rng.random() < 0.3 else [])
        row = list(scanner.scan(pa.array([" ".join(doc)]), 0.0))[0]
        got = {}
        for s in row["spans"]:
            assert doc[s["doc_word"]:s["doc_word"] + s["words"]] == seqs[int(
                [lab for lab, _ in templates].index(s["label"]))][s["template_word"]:s["template_word"] + s["words"]]
            got[s["label"]] = got.get(s["label"], 0) + s["words"]
        for (label, _), t in zip(templates, seqs):
            # pairs of words inside common runs of four words, then the longest chain of them
            ok = np.zeros((len(doc), len(t)), bool)
            for i in range(len(doc) - 3):
                for j in range(len(t) - 3):
                    if doc[i:i + 4] == t[j:j + 4]:
                        ok[range(i, i + 4), range(j, j + 4)] = True
            best = np.zeros((len(doc) + 1, len(t) + 1), int)
            for i in range(len(doc)):
                for j in range(len(t)):
                    best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + ok[i, j])
            assert got.get(label, 0) == best[-1, -1]
