"""False-discovery control over a table, against Benjamini-Hochberg written out."""

import random
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from quirestone.llm import secret_scan as S


def plain_bh(found, q):
    """Places of the (p, length) that weighted Benjamini-Hochberg keeps."""
    mean = sum(n for _, n in found) / len(found)
    order = sorted(range(len(found)), key=lambda i: found[i][0] * mean / found[i][1])
    last = max((k for k, i in enumerate(order, 1) if found[i][0] * mean / found[i][1] <= q * k / len(found)), default=0)
    return set(order[:last])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1e-9, 1e-5, 3e-4, 1e-3, 2e-2, 0.4, 1.0]), st.integers(20, 80)), min_size=1, max_size=40), st.sampled_from([1e-3, 0.05]))
def test_cut_is_the_rule_up_to_a_bin(found, q):
    bins = {}
    for p, n in found:
        b = bins.setdefault(S.bin_of(p, n), [0, 0])
        b[0] += 1
        b[1] += n
    cut = S.cut_of([(k, *v) for k, v in bins.items()], q)
    kept = set() if cut is None else {i for i, (p, n) in enumerate(found) if S.bin_of(p, n) <= cut}
    assert kept <= plain_bh(found, q)
    # at a level one bin lower the exact rule keeps no more
    assert plain_bh(found, q * 10 ** (-1.001 / S.BINS)) <= kept


def test_findings_of_a_table_by_brute_force(spark):
    r = random.Random(8)
    some = lambda n, letters=string.ascii_letters + string.digits: "".join(r.choice(letters) for _ in range(n))
    names = ["AbstractSingletonProxyFactoryBean", "getElementsByClassNameAndTag", "ConcurrentHashMapSegmentTableEntry", "Internationalization_of_the_thing", "some-kind-of-long-hyphenated-name"]
    texts = [f"see {some(r.randrange(28, 60))} and {r.choice(names)}" for _ in range(30)] + [f"x {n} y {m}" for n in names for m in names] + [None, "", "plain", "password: abcdef123 " + some(40)]
    texts += ["a=" + some(44) + "==", some(20000, string.ascii_lowercase + " ")]
    got = {x["doc_id"]: x["spans"] for x in S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    found = [(i, *c) for i, t in enumerate(texts) for c in S.candidates(t or "", S.base_spans(t or ""))]
    keep = plain_bh([(p, e - s) for _, s, e, p in found], S.Q)
    want = {i: set() for i in range(len(texts))}
    for k in keep:
        want[found[k][0]].add(f"random:{found[k][1]}:{found[k][2]}")
    missed = 0
    for i in range(len(texts)):
        mine = {x for x in got[i].split(",") if x.startswith("random")}
        assert mine <= want[i]
        missed += len(want[i] - mine)
    assert missed <= 1 and sum(bool(want[i]) for i in range(30)) >= 29 and not any(want[i] for i in range(30, 55))
    assert S.corpus_cut(spark.createDataFrame([], "doc_id long, text string")) is None
