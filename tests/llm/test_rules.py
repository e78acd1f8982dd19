from divtide.llm import quality_rules as rules
from tests.llm.conftest import EDGES, prose


def test_edges(frame):
    out = {(r["doc_id"], r["n_words"]): r for r in rules.judge(rules.ledger(frame(EDGES))).collect()}
    assert out[1, 0]["fail_bits"] == rules.BIT["few_words"] and not out[1, 0]["kept"]
    assert out[None, 3]["base_failed"] and out[3, 0]["n_lines"] == 0
    assert out[5, 60]["kept"] and out[6, 30_000]["kept"]
    assert rules.ledger(frame([])).count() == 0


def test_repeats(frame):
    text = "a b c x a b c y\na b c\nz\nz\n z"
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    row = rules.measure(frame([(1, text)])).first()
    assert row["n_repeat_words"] == len(covered)
    assert (row["n_dup_lines"], row["n_lines"]) == (1, 5)


def test_overlapping_windows(frame):
    """Windows that overlap themselves cover each word once."""
    row = rules.measure(frame([(1, "q " * 7)])).first()
    assert row["n_repeat_words"] == 7


def test_policies_and_ablations(frame):
    good = prose(1, 80)
    docs = frame([(1, good), (2, good.upper()), (3, "$ " * 60 + good), (4, "short")])
    book = rules.ledger(docs)
    kept = {v: sorted(r["doc_id"] for r in rules.judge(book, v).where("kept").collect()) for v in rules.POLICIES}
    assert kept == {"v1": [1, 2, 3], "v2": [1]}
    effect = {r["rule"]: (r["failing"], r["kept"], r["kept_without"]) for r in rules.ablations(book).collect()}
    assert effect["capitals"] == (1, 1, 2)
    assert effect["symbols"] == (1, 1, 2)
    assert effect["few_words"] == (1, 1, 2)
    assert effect["long_words"][0] == 0


def test_keep_good_carries_all_columns(frame):
    docs = frame([*EDGES, (8, prose(9, 70))])
    out = rules.keep_good(docs)
    assert out.schema == docs.schema
    assert sorted(r["doc_id"] for r in out.collect()) == [5, 5, 6, 8]
    assert {r["row"] for r in out.collect()} == {"r"}
