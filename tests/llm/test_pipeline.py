"""The pipeline, stage by stage, against brute force on a small table."""

import base64
import hashlib
import random
from itertools import combinations

import pytest
from tests.llm.helpers import DOCS, LOWER, least_reachable, table, words

import corpus_pipeline as pipeline

P = pytest.importorskip("public_tokenizers")


def made_documents():
    r = random.Random(11)
    sounds = {"aa": ["la", "lo", "mi", "re"], "bb": ["kr", "itz", "och", "ung"]}
    say = lambda lang, n: " ".join("".join(r.choice(sounds[lang]) for _ in range(3)) for _ in range(n))
    passage, rows = say("aa", 40), []
    for i in range(120):
        lang = r.choice(list(sounds))
        text = say(lang, r.randint(5, 80))
        if i % 6 == 1 and rows:
            text = rows[r.randrange(len(rows))][1]
        elif i % 6 == 3:
            text = f"{say('aa', 15)}\n{passage}\n{say('aa', 15)}"
        rows.append((i, text, lang, f"s{i % 4}" if i % 9 else None, len(text)))
    return rows + [(200, None, None, "s1", 0), (201, "", "aa", "s1", 0), (202, "12 34 !!", "aa", "s2", 8), (203, say("bb", 6), None, "s2", 9)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    table(spark, made_documents(), DOCS).write.parquet(f"{folder}/documents.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{len(found)}")
        docs = spark.read.parquet(f"{folder}/{len(found)}")
        found.append((docs.columns, docs.collect()))
    return folder, found


def test_shapes(stages):
    assert all(columns == pipeline.COLUMNS for columns, _ in stages[1][:-1]) and len(pipeline.STAGES) == 5


def test_language_stage(stages):
    kept = {r["doc_id"]: r for r in stages[1][0][1]}
    assert set(kept) == {*range(120), 203} and kept[203]["lang"] == "bb"


def test_near_copies_stage(stages):
    rows = {r["doc_id"]: r["text"] for r in stages[1][0][1]}
    sets = {}
    for i, t in rows.items():
        w = words(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    links = [(a, b) for a, b in combinations(rows, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = least_reachable(rows, links)
    assert {r["doc_id"] for r in stages[1][1][1]} == {i for i in rows if low[i] == i}


def test_passages_stage(stages):
    rows, first, expected = {r["doc_id"]: r["text"] for r in stages[1][1][1]}, {}, {}
    for i, t in rows.items():
        w = words(t)
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    for i, t in rows.items():
        w = words(t)
        gone = {x for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for x in range(k, k + 13)}
        if not gone or len(gone) < len(w):
            expected[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    assert {r["doc_id"]: r["text"] for r in stages[1][2][1]} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1][2][1] if r["doc_id"] < 120)


def test_mixing_stage(stages):
    before, after = stages[1][2][1], stages[1][3][1]
    size = {s: sum(len(words(r["text"])) for r in before if r["source"] == s) for s in {r["source"] for r in before}}
    from tallyforge.llm.mixing import targets

    longest = {s: max(len(words(r["text"])) for r in before if r["source"] == s) for s in size}
    for s, t in targets(size).items():
        assert abs(sum(len(words(r["text"])) for r in after if r["source"] == s) - int(t)) <= longest[s] / 2
    texts = {(r["doc_id"], r["text"]) for r in before}
    assert all((r["doc_id"], r["text"]) in texts for r in after)
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}


def test_token_stage(stages):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((r["doc_id"], library.encode_ordinary(r["text"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in stages[1][3][1])
    assert sorted((r["doc_id"], r["token_ids"], r["decoded_sha256"]) for r in stages[1][4][1]) == expected
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in stages[1][4][1])


def test_run_gives_the_same_rows(spark, stages):
    again = sorted((r["doc_id"], r["token_ids"]) for r in pipeline.run(spark, stages[0]).collect())
    assert again == sorted((r["doc_id"], r["token_ids"]) for r in stages[1][4][1])


def test_repeated_rows_leave_one(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "aa", "s", 1) for i in range(5)]
    docs = table(spark, rows + rows + [(9, "other text", None, None, None), (9, "another one", None, None, None)], DOCS)
    left = pipeline.near_copies(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in left) == [0, 1, 2, 3, 4, 9, 9] and len({r["text"] for r in left}) == 7


def test_stages_of_no_documents_and_of_clashing_columns(spark):
    docs = table(spark, made_documents()[:40], DOCS).selectExpr("*", "1 as size", "2 as taken", "3 as kept", "4 as _place", "5 as copies", "'x' as token_ids")
    for _, stage in pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), "").count() == 0
        assert stage(spark, docs, "").count() > 0


def test_a_very_long_text_goes_through_whole(spark):
    r = random.Random(3)
    long = " ".join(f"v{r.randrange(10**9)}" for _ in range(250_000))
    docs = table(spark, [(1, long, "aa", "s", len(long)), (2, "a short one", "aa", "s", 11)], DOCS)
    for _, stage in pipeline.STAGES[1:4]:
        docs = stage(spark, docs, "")
    assert {r["text"] for r in docs.collect()} == {long, "a short one"}
