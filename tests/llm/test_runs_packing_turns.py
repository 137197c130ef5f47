import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyforge.llm import best_fit, periodic_runs, turn_repair
from tests.llm.helpers import table, words

DEFINITION = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def runs_by_definition(ws):
    best = {}
    for q in range(1, len(ws) // 4 + 1):
        i = 0
        while i + q < len(ws):
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in best.items())


def collapsed_by_definition(ws):
    gone = {i for start, length, q in runs_by_definition(ws) for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def periodic_text(rng):
    kinds = rng.choice([1, 2, 3, 5, 30])
    ws = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(rng.choice([12, 60, 300])))]
    for _ in range(rng.randrange(4)):
        at, period = rng.randrange(len(ws) + 1), rng.randrange(1, 12)
        unit = [f"w{rng.randrange(kinds)}" for _ in range(period)]
        ws[at:at] = [unit[i % period] for i in range(rng.randrange(1, 80))]
    return rng.choice([" ", "\n", " \t"]).join(ws)


def test_runs_of_random_texts(spark):
    rng = random.Random(3)
    texts = [periodic_text(rng) for _ in range(800)] + ["", None, "a", "a a a a a", "a a a a a a", " x ", "a b a b a b a b", "Ä ä " * 9, "  " * 7]
    found = periodic_runs.find_runs(table(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for row in found:
        ws = words(texts[row.doc_id])
        assert row.n_words == len(ws)
        assert [tuple(r) for r in row.runs] == runs_by_definition(ws)
        assert row.collapsed == collapsed_by_definition(ws)


def test_runs_that_touch_and_nest(spark):
    texts = ["a a a a a a b b b b b b", " ".join(["a a a a a a b"] * 5), " ".join(["x y"] * 8 + ["y x"] * 8), "z " + "p q r " * 4 + "p q s"]
    found = periodic_runs.find_runs(table(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[tuple(r) for r in row.runs] for row in found] == [runs_by_definition(t.split()) for t in texts]
    assert (0, 35, 7) in [tuple(r) for r in found[1].runs]


def test_long_periods_of_a_very_long_text():
    rng = random.Random(8)
    unit = [f"u{rng.randrange(10**9)}" for _ in range(30_000)]
    lone = [f"v{rng.randrange(10**9)}" for _ in range(1_000)]
    text = " ".join(lone + unit * 5 + ["a"] * 50_000 + lone)
    (chunk,) = list(periodic_runs.chunks(__import__("pyarrow").array([text])))
    _, runs, stay = periodic_runs.chunk_runs(chunk)
    assert runs.tolist() == [[1_000, 150_000, 30_000], [151_000, 50_000, 1]]
    assert stay.sum() == 1_000 + 30_000 + 1 + 1_000


def test_splitting_leaves_nothing_of_common_words_between_rare_ones():
    codes = np.array([0, 1, 0, 2, 0, 3, 0, 4, 0, 5, 5, 5, 5, 5, 5, 6])
    starts, ends = periodic_runs.surviving_segments(codes, np.array([0, len(codes)]))
    assert (starts.tolist(), ends.tolist()) == ([9], [15])


def test_runs_keep_other_columns_and_replace_outputs(spark):
    rows = table(spark, [(None, "q q q q q q", 5, "kept"), (None, "q q q q q q", 5, "kept")], "doc_id long, text string, n_words int, length string")
    found = periodic_runs.find_runs(rows)
    assert found.columns == ["doc_id", "text", "length", "n_words", "runs", "collapsed"]
    assert [tuple(r)[1:] for r in found.collect()] == [("q q q q q q", "kept", 6, [(0, 6, 1)], "q")] * 2
    assert periodic_runs.find_runs(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(rows.withColumnRenamed("text", "runs"), "runs")


# Best-fit packing


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_against_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0 if seed else 1, [65, 65, 20, 64][seed], 400)
    into, offset, fill = best_fit.best_fit(sizes, 64)
    bins = []
    for size in sorted(sizes.tolist(), reverse=True):
        fits = [b for b in bins if b + size <= 64]
        if fits:
            bins.remove(max(fits))
        bins.append((max(fits) if fits else 0) + size)
    assert sorted(bins) == sorted(fill.tolist())
    for b in range(len(fill)):
        own = sorted(zip(offset[into == b].tolist(), sizes[into == b].tolist()))
        assert sum(s for _, s in own) == fill[b] <= 64
        assert all(a + s == b2 for (a, s), (b2, _) in zip(own, own[1:])) and own[0][0] == 0


def test_cut():
    document, number, start, length = best_fit.cut(np.array([1, 10, 11, 30]), 10)
    assert list(zip(document.tolist(), number.tolist(), start.tolist(), length.tolist())) == [
        (0, 0, 0, 1), (1, 0, 0, 10), (2, 0, 0, 1), (2, 1, 1, 10), (3, 0, 0, 10), (3, 1, 10, 10), (3, 2, 20, 10),
    ]


def check_packing(rows, texts, capacity):
    """All pieces against the library; sequences without gaps; the number of sequences."""
    library = Tokenizer.from_file(DEFINITION)
    wanted = []
    for name, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) - (math.ceil(len(ids) / capacity) - 1) * capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        wanted += [(-1 if name is None else name, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    got = [(-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.token_ids) for r in rows]
    assert sorted(got) == sorted(wanted)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= capacity
    return len(sequences), sum(w[3] for w in wanted)


def test_packing(spark):
    rng = random.Random(5)
    odd = ["", None, "<|endoftext|>", "a <|endoftext|>b", "漢字 \U0001f600  x", "'s 't don't", " \n\n  x", "x" * 5000, " " * 3000]
    texts = [(i, "".join(rng.choice("abcd é.\n") for _ in range(rng.randrange(300)))) for i in range(300)] + [(None, t) for t in odd] + [(7, "same")] * 5
    docs = table(spark, [(i, t, 1, "x") for i, t in texts], "doc_id long, text string, offset int, token_ids string").repartition(6)
    packed = best_fit.pack_documents(docs, DEFINITION, capacity=64)
    count, total = check_packing(packed.collect(), texts, 64)
    assert count <= 1.02 * total / 64 + 1
    for row in best_fit.sequences(packed).collect():
        assert len(row.token_ids) == sum(p.length for p in row.parts) <= 64
    assert best_fit.pack_documents(docs.where("false"), DEFINITION).count() == 0


def test_rounds_merge_what_tasks_leave(spark, monkeypatch):
    monkeypatch.setattr(best_fit, "ITEMS", 8)
    monkeypatch.setattr(best_fit, "FAN", 2)
    texts = [(i, " ".join(["a"] * 19)) for i in range(64)]  # 20 ids each: three fit in 64
    docs = table(spark, texts, "doc_id long, text string").repartition(32)
    count, total = check_packing(best_fit.pack_documents(docs, DEFINITION, capacity=64).collect(), texts, 64)
    assert total == 64 * 20 and count <= 26  # 22 at best; tasks of eight items leave some open
    wide = [(i, " ".join(["a"] * 39)) for i in range(40)]  # no two fit
    count, _ = check_packing(best_fit.pack_documents(table(spark, wide, "doc_id long, text string").repartition(20), DEFINITION, capacity=64).collect(), wide, 64)
    assert count == 40


def test_a_text_of_megabytes_is_packed_whole(spark):
    texts = [(1, "word and " * 400_000), (2, "short")]
    packed = best_fit.pack_documents(table(spark, texts, "doc_id long, text string"), DEFINITION).drop("token_ids").collect()
    assert sum(r.length for r in packed if r.doc_id == 1) == 800_002
    assert {r.length for r in packed if r.doc_id == 1 and r.piece} == {1024}


# Conversations

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def repaired_by_definition(rows):
    """What the contract says, state by state from the last turn to the first."""
    ordered = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    faults, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in ordered:
        kind = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else ""
        seen.add((role, text))
        if kind:
            counts[kind] += 1
        faults.append(kind)
    initials = [r[:1] for _, _, r, _ in ordered]
    counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def put_in(best):
        best = dict(best)
        for _ in range(4):
            for state, ways in moves.items():
                for to in ways:
                    if to != "s" and to in best:
                        way = (best[to][0] + 5, "I" + best[to][1], [f"{full[to]}:", *best[to][2]])
                        if state not in best or way[:2] < best[state][:2]:
                            best[state] = way
        return best

    best = put_in(best)
    for (_, _, role, text), fault in reversed(list(zip(ordered, faults))):
        now = {}
        for state in moves:
            ways = [(best[state][0] + 2, "D" + best[state][1], best[state][2])]
            if fault not in ("blank", "duplicate"):
                charge = 5 if fault == "truncated" else 0
                for to in moves[state]:
                    if role[:1] == to:
                        ways.append((best[to][0] + charge, "K" + best[to][1], [f"{role}:{text}", *best[to][2]]))
                    if to != "s":
                        ways.append((best[to][0] + 1 + charge, "R" + best[to][1], [f"{full[to]}:{text}", *best[to][2]]))
            now[state] = min(ways, key=lambda w: w[:2])
        best = put_in(now)
    cost, audit, lines = best[""]
    return counts | {"cost": cost, "audit": audit, "sha": sha("\n".join(lines))}


def conversation(rng, length):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    said = ["yes.", "no", "", " \t", None, "why?", "a!\n", "b.", "c. d", "e"]
    rows = []
    for i in range(length):
        role = rng.choice(roles) if rng.random() < 0.3 else roles[i % 2]
        text = rng.choice(said) if rng.random() < 0.3 else f"t{rng.randrange(10**6)}" + rng.choice([".", ".", "?", ""])
        rows.append((rng.choice([None, i, i, i, i + rng.randrange(5)]), role, text))
        if rng.random() < 0.1:
            rows += [rows[-1]] * rng.randrange(1, 4)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk_turns", [2, 5, 8192])
def test_repairs(spark, chunk_turns):
    rng = random.Random(chunk_turns)
    made = {i: conversation(rng, rng.randrange(1, 9)) for i in range(150)} | {None: conversation(rng, 12), 500: conversation(rng, 400), 501: [(None, "user", "x.")] * 300 + [(1, "user", "y.")]}
    made = {c: distinct_in_turn(rows) for c, rows in made.items()}
    rows = [(c, *r, 1) for c, rs in made.items() for r in rs]
    rng.shuffle(rows)
    given = table(spark, rows, "conv_id long, turn long, role string, text string, position int").repartition(5)
    repair = turn_repair.repair_turns(given, chunk_turns=chunk_turns)
    digests = {r.conv_id: r.repaired_sha256 for r in turn_repair.digest_turns(repair.turns).collect()}
    found = {r.conv_id: r for r in repair.summary.collect()}
    assert set(found) == set(made)
    for c, rs in made.items():
        wanted = repaired_by_definition(rs)
        assert digests.get(c, sha("")) == wanted.pop("sha"), (c, rs, found[c].audit, wanted)
        assert {k: found[c][k] for k in wanted} == wanted, (c, rs)
    letters = {}
    for e in repair.edits.orderBy("position").collect():
        letters[e.conv_id] = letters.get(e.conv_id, "") + e.action * e.copies
    assert letters == {c: r.audit for c, r in found.items() if r.audit}


def distinct_in_turn(rows):
    """Rows of one turn and role have one text, so that their order is settled; copies stay."""
    said = {}
    return [(t, r, said.setdefault((t, " " if r is None else r), x)) for t, r, x in rows]


def test_passes_rerun_chunks_until_nothing_changes(spark):
    # Turns that may all stay or all be renamed: what is cheaper is known at the far end only.
    rows = [(1, i, ["assistant", "user"][i % 2], f"{i}.") for i in range(60)]
    (row,) = turn_repair.repair_turns(table(spark, rows, "conv_id long, turn long, role string, text string"), chunk_turns=4).summary.collect()
    wanted = repaired_by_definition([r[1:] for r in rows])
    assert (row.audit, row.cost) == (wanted["audit"], wanted["cost"])


def test_refit_stops_where_vectors_differ_by_a_constant():
    codes = bytes(random.Random(1).choice([1, 2, 5, 6, 9]) for _ in range(200))
    guess = turn_repair.backward(codes, turn_repair.ENDED)
    for true in [(0, 0, 0, 0), (3, 8, 0, 5), (9, 4, 0, 5)]:
        assert turn_repair.refit(codes, turn_repair.ENDED, true, guess) == turn_repair.backward(codes, true)


def test_no_conversations(spark):
    repair = turn_repair.repair_turns(table(spark, [], "conv_id string, turn int, role string, text string"))
    assert (repair.summary.count(), repair.edits.count(), turn_repair.digest_turns(repair.turns).count()) == (0, 0, 0)


def test_names_of_any_type(spark):
    rows = [("b", 1, "user", "Hi."), ("b", 2, "assistant", "Ho."), ("a", 1, "assistant", "Alone.")]
    found = {r.conv_id: r.audit for r in turn_repair.repair_turns(table(spark, rows, "conv_id string, turn int, role string, text string")).summary.collect()}
    assert found == {"a": "D", "b": "KK"}
