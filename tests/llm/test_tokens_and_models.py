"""Tokenizers, files, language, scores, mixing, vectors and archives."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tallyforge.llm import bpe, lang_id, mixing, ngram_lm, token_files, warc
from tallyforge.llm.embedding_dedup import near_vectors, rotation
from tallyforge.llm.ngram_lm import score_texts
from tallyforge.llm.storage import Scratch
from tallyforge.llm.text import chunks
from tests.llm.helpers import LOWER, documents, least_reachable, table, words

P = pytest.importorskip("public_tokenizers")
PIECES = [
    "a", "B", "s", "re", "ve", "'s", "'", "''", "don't", " ", "  ", "\n", "\t", "\r\n", "1", "23", "é", "É", "Ω", "Σ", "!", "-", "\x1c", "\x00", "😀", "中", "٣",
    "<|endoftext|>", "<|ENDOFTEXT|>", "ß", "İ", "×", "½", "\x85", "́", "#x&",
]


def odd_texts(n=1500):
    r = random.Random(8)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(n)]
    texts += ["".join(chr(r.choice([r.randrange(0x20, 0x250), r.randrange(0x250, 0xD7FF), r.randrange(0xE000, 0x110000)])) for _ in range(20)) for _ in range(300)]
    return texts + ["", "a" * 3000, " " * 90, "'" * 30, "ab" * 500 + "! "]


def test_byte_bpe_is_that_of_the_library():
    import tiktoken

    raw = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
    own = bpe.Tokenizer(raw, bpe.code_point_classes())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts()
    for chunk in chunks(pa.array(texts), 2000):
        ids, counts = own.encode(chunk)
        edges = np.concatenate([[0], np.cumsum(counts)])
        for text, a, b in zip(texts[chunk.first : chunk.last], edges[:-1], edges[1:]):
            assert ids[a:b].tolist() == library.encode_ordinary(text)
            assert own.decode(ids[a:b]).tobytes() == text.encode()


def test_byte_bpe_tables(spark):
    texts = [None, "", "Hello  world's end\n", "x" * 500]
    docs = documents(spark, texts).withColumnRenamed("source", "token_ends")
    coded = bpe.encode(docs, P.path("byte_bpe_50k.tiktoken"))
    assert coded.columns == ["doc_id", "text", "lang", "n_chars", "token_ids", "token_ends"]
    for row in bpe.decode(coded, P.path("byte_bpe_50k.tiktoken")).collect():
        raw = (row["text"] or "").encode()
        assert bytes(row["decoded"]) == raw and len(row["token_ids"]) == len(row["token_ends"]) and (row["token_ends"] or [0])[-1] == len(raw)
    digests = {r["doc_id"]: r for r in bpe.digests(docs, P.path("byte_bpe_50k.tiktoken")).collect()}
    assert digests[0]["n_tokens"] == 0 and digests[0]["ids_sha256"] == digests[0]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.encode(table(spark, []), P.path("byte_bpe_50k.tiktoken")).count() == 0


def test_word_tokenizer_is_that_of_the_library():
    from tokenizers import Tokenizer

    definition = open(P.path("word_bpe_49k.json")).read()
    own, library = token_files.WordTokenizer(definition), Tokenizer.from_str(definition)
    texts = odd_texts()
    for chunk in chunks(pa.array(texts), 2000):
        ids, counts = own.encode(chunk)
        edges = np.concatenate([[0], np.cumsum(counts)])
        for text, a, b in zip(texts[chunk.first : chunk.last], edges[:-1], edges[1:]):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [(9, "nine"), (2, None), (5, "five and more"), (5, "five and more"), (None, "no id"), (7, "")]
    docs = table(spark, [(i, t, None, None, None) for i, t in rows])
    folder = Scratch(spark, "test").folder()
    token_files.write_tokens(docs, P.path("word_bpe_49k.json"), folder, partitions=3)
    found = token_files.read_tokens(spark, folder, ["token_ids", "ids_crc32"]).collect()
    expected, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert sorted(r["doc_id"] for r in token_files.read_tokens(spark, folder, [], first_id=5, last_id=7).collect()) == [5, 5, 7]
    assert token_files.read_tokens(spark, folder, []).columns == ["doc_id", "start", "n_tokens"]
    empty = Scratch(spark, "test").folder()
    token_files.write_tokens(table(spark, []), P.path("word_bpe_49k.json"), empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_language(spark):
    r = random.Random(1)
    sounds = {"aa": ["la", "lo", "mi", "re"], "bb": ["kr", "itz", "och", "ung"], "cc": ["þa", "éo", "ñu", "ßi"]}
    say = lambda lang, n: " ".join("".join(r.choice(sounds[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(lang := r.choice(list(sounds)), r.randint(3, 60)), lang, None, None) for i in range(300)]
    odd = [(900, None, "aa", None, None), (901, "12 !!", "aa", None, None), (902, "", None, None, None), (903, "שלום עולם " * 9, None, None, None), (None, say("bb", 9), "bb", None, None)]
    docs = table(spark, rows + odd)
    model = lang_id.fit(docs.where("doc_id is null or doc_id % 3 > 0"), sample=100)
    found = {x["doc_id"]: x for x in lang_id.identify(docs.withColumnRenamed("source", "score"), model).collect()}
    tested = [x for i, x in found.items() if i is not None and i < 300 and i % 3 == 0]
    assert sum(x["lang_pred"] == x["lang"] for x in tested) >= 0.98 * len(tested) and not any(x["rejected"] for x in tested)
    for i in (900, 901, 902):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    assert found[903]["rejected"] and found[None]["lang_pred"] == "bb" and all(0 <= x["score"] <= 1 for x in found.values())
    nothing = lang_id.fit(docs.where("false"))
    assert {x["lang_pred"] for x in lang_id.identify(docs, nothing).collect()} == {"und"}


def test_long_texts_of_no_learned_language_are_rejected(spark):
    """Long texts in a script or a language that the model was not fitted on go; short and long ones of a learned language stay."""
    r = random.Random(7)
    syllables = lambda letters: ["".join(r.choice(letters) for _ in range(3)) for _ in range(40)]
    sounds = {lang: syllables(letters) for lang, letters in (("aa", "abdeilmor"), ("bb", "cghknostuz"), ("cc", "aefijpqvwy"))}
    say = lambda parts, n: " ".join("".join(r.choice(parts) for _ in range(2)) for _ in range(n))
    rows = [(i, say(sounds[lang], r.choice([3, 10, 80, 400])), lang, None, None) for i, lang in enumerate(r.choices(["aa", "bb", "cc"], k=400))]
    strange = {"script": [chr(c) for c in range(0x430, 0x450)], "greek": [chr(c) for c in range(0x3B1, 0x3CA)], "letters": list("abcdefghijklmnopqrstuvwxyz")}
    far = [(1000 + i, say(syllables(letters), n), None, None, None) for i, (letters, n) in enumerate((x, n) for x in strange.values() for n in (50, 300, 2000))]
    docs = table(spark, rows)
    found = lang_id.identify(table(spark, rows + far), lang_id.fit(docs, sample=200)).collect()
    assert not [x["doc_id"] for x in found if x["doc_id"] < 1000 and x["rejected"]]
    assert all(x["rejected"] for x in found if x["doc_id"] >= 1000)
    left_out = lang_id.fit(docs.where("lang != 'cc'"), sample=200)
    assert all(x["rejected"] for x in lang_id.identify(docs.where("lang = 'cc' and length(text) > 1000"), left_out).collect())


@pytest.mark.parametrize("entries", [1 << 21, 300])
def test_scores(spark, monkeypatch, entries):
    monkeypatch.setattr("tallyforge.llm.packing.BUCKET_ENTRIES", entries)
    r = random.Random(2)
    chain = {f"w{i}": [f"w{(i * k + 1) % 30}" for k in (2, 3)] for i in range(30)}
    texts = [None, "", "W1 w1"]
    while len(texts) < 120:
        w = [f"w{r.randrange(30)}"]
        while len(w) < r.randint(5, 60):
            w.append(r.choice(chain[w[-1]]))
        texts.append(" ".join(w))
    held = {i for i in range(len(texts)) if i % 5 == 1}
    found = {x["doc_id"]: x for x in score_texts(documents(spark, texts), F.col("doc_id") % 5 == 1).collect()}
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in enumerate(texts)}
    counts = collections.Counter(w for i, t in tokens.items() if i not in held for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        x, base = found[i], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"]) == (i in held, len(t), sum(counts[w] > 0 for w in t), n)
        assert x["base_score"] == pytest.approx(base) and x["score"] < 0
    assert sum(found[i]["score"] for i in held) > 0.8 * sum(found[i]["base_score"] for i in held)
    assert score_texts(table(spark, []), F.lit(True)).count() == 0
    assert {x["train_tokens"] for x in score_texts(documents(spark, texts[:4]), F.lit(True)).collect()} == {0}


def test_filter_keeps_its_bits_per_entry():
    """A slice of 800,000 entries, twice what 64 MB left each of 256 slices: unseen values still read as 0 as often as 10 bits allow."""
    r = np.random.Generator(np.random.PCG64(6))
    seen, unseen = np.unique(r.integers(0, 1 << 63, 400_000, dtype=np.uint64)), r.integers(1 << 63, 1 << 64, 20_000, dtype=np.uint64)
    levels = 1 + np.arange(len(seen)) % 3
    flags = ngram_lm.filled(seen, levels)
    assert len(flags) >= ngram_lm.BITS_PER_ENTRY * levels.sum()
    assert (ngram_lm.reached(flags, seen) >= levels).all() and (ngram_lm.reached(flags, unseen) > 0).mean() < 0.012
    one = ngram_lm.Filter(0, np.array([0]), np.array([len(flags)]), [np.packbits(flags).tobytes()])
    asked = np.concatenate([seen[:5000], unseen])
    assert (one.reached(asked) == ngram_lm.reached(flags, asked)).all()
    assert not ngram_lm.Filter(3, np.zeros(0, np.int64), np.zeros(0, np.int64), []).reached(asked).any()


def scores_by_hand(training, texts):
    """The stated smoothing with exact counts in place of the filter."""
    floors = [1.5**q for q in range(64)]
    level = lambda c: sum(f <= c for f in floors)
    mean = lambda q: max(1.0, (math.ceil(floors[q - 1]) + math.ceil(1.5 * floors[q - 1]) - 1) / 2) if q else 0.0
    tokens = lambda t: [*words((t or "").translate(LOWER)), None]
    counts, pairs = collections.Counter(), collections.Counter()
    for t in map(tokens, training):
        counts.update(t)
        pairs.update(zip([None, *t], t))
    n, v, seen, kinds = sum(counts.values()), len(counts), collections.Counter(), collections.Counter()
    for c in counts.values():
        seen[level(c)] += c
    for a, _ in pairs:
        kinds[level(counts[a])] += 1
    out = []
    for t in map(tokens, texts):
        total = 0.0
        for a, b in zip([None, *t], t):
            q = level(counts[a])
            weight = max(1e-6, kinds[q] / (kinds[q] + seen[q])) if q and seen[q] else 1.0
            alone = (counts[b] + 0.5) / (n + 0.5 * (v + 1))
            total += math.log10((1 - weight) * min(mean(level(pairs[a, b])), counts[a], counts[b]) / max(counts[a], 1) + weight * alone)
        out.append(total)
    return out


@pytest.mark.parametrize("entries", [1 << 21, 300])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_scores_by_brute_force(spark, monkeypatch, tmp_path, entries, limit):
    """A filter with room enough gives the scores of exact counts, broadcast or by bucket, on training texts and on new ones."""
    monkeypatch.setattr("tallyforge.llm.packing.BUCKET_ENTRIES", entries)
    r = random.Random(11)
    say = lambda n: " ".join(r.choice("abcdefghij") + r.choice("XYZxyz") for _ in range(n))
    texts = [None, "", "a", "\n", *(say(r.randint(1, 80)) for _ in range(100)), say(30_000), *[say(20)] * 5]
    docs = documents(spark, texts).withColumn("held_out", F.lit("mine")).withColumn("chunk", F.lit("mine"))
    held = [i % 5 == 1 for i in range(len(texts))]
    training = [t for t, h in zip(texts, held) if not h]
    found = {x["doc_id"]: x for x in ngram_lm.score_texts(docs, F.col("doc_id") % 5 == 1, bits_per_entry=160).collect()}
    assert [found[i]["score"] for i in range(len(texts))] == pytest.approx(scores_by_hand(training, texts))
    model = ngram_lm.fit(docs.where("doc_id % 5 != 1"), str(tmp_path / "model"), bits_per_entry=160)
    new = [*texts, "unheard words only", *(say(50) + f" new{i}" for i in range(40))]
    again = {x["doc_id"]: x for x in ngram_lm.score(documents(spark, new), ngram_lm.load(spark, str(tmp_path / "model")), broadcast_bytes=limit).collect()}
    assert [again[i]["score"] for i in range(len(new))] == pytest.approx(scores_by_hand(training, new))
    assert all(again[i][c] == found[i][c] for i in found for c in ("n_tokens", "n_known", "train_tokens")) and model.tokens == found[0]["train_tokens"]
    assert again[len(texts)]["n_known"] == 1  # its end


def test_scores_with_filter_errors(spark, tmp_path):
    """With the production bits a few absent pairs read as present, alike in both ways of reading; scores hardly move."""
    r = random.Random(12)
    texts = [" ".join(f"w{int(r.paretovariate(0.7))}" for _ in range(100)) for _ in range(200)]
    docs, folder = documents(spark, texts), str(tmp_path / "model")
    a = {x["doc_id"]: x["score"] for x in ngram_lm.score_texts(docs, F.col("doc_id") % 2 == 1, folder=folder).collect()}
    for size in (0, 1 << 20):
        assert a == {x["doc_id"]: x["score"] for x in ngram_lm.score(docs, ngram_lm.load(spark, folder), broadcast_bytes=size).collect()}
    exact = scores_by_hand(texts[::2], texts)
    assert all(-1e-9 <= a[i] - exact[i] < 0.05 * -exact[i] for i in a) and sum(a.values()) - sum(exact) < 0.01 * -sum(exact)


def test_scores_of_no_training_text(spark, tmp_path):
    model = ngram_lm.fit(table(spark, []), str(tmp_path / "empty"))
    for limit in (0, 1 << 20):
        found = ngram_lm.score(documents(spark, ["a b", None]), model, broadcast_bytes=limit).orderBy("doc_id").collect()
        assert [x["n_tokens"] for x in found] == [3, 1] and [x["score"] for x in found] == pytest.approx([0.0, 0.0])
        assert ngram_lm.score(table(spark, []), model, broadcast_bytes=limit).count() == 0


def test_scores_of_unseen_pairs(spark, monkeypatch):
    """Pairs that no training text has score as such, in every one of many slices."""
    monkeypatch.setattr("tallyforge.llm.packing.BUCKET_ENTRIES", 300)
    r = random.Random(5)
    texts = [" ".join(f"w{(j := r.randrange(400))} v{j}" for _ in range(60)) for _ in range(200)]
    texts += [" ".join(f"w{r.randrange(400)}" for _ in range(200)) for _ in range(5)]
    found = {x["doc_id"]: x for x in score_texts(documents(spark, texts), F.col("doc_id") >= 195).collect()}
    counts = collections.Counter(w for t in texts[:195] for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    alone = {w: (c + 0.5) / (n + 0.5 * (v + 1)) for w, c in counts.items()}
    for i in range(200, 205):
        assert found[i]["score"] < sum(math.log10(alone[w]) for w in [*words(texts[i]), None])
    for i in range(195, 200):
        assert found[i]["score"] > found[i]["base_score"] + 50


def test_mixing(spark):
    r = random.Random(3)
    texts = [" ".join(["w"] * r.randint(0, 50)) or None for _ in range(200)]
    docs = documents(spark, texts, lambda i: None if i % 7 == 0 else f"s{i * i % 5}").withColumnRenamed("lang", "taken")
    mixed = mixing.mix(docs, F.array("source")).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix(docs.repartition(3), F.array("source")).collect()))
    by_source = collections.defaultdict(list)
    for x in mixed:
        assert x["size"] == len(words(x["text"])) and 0 <= x["taken"] <= 2 * x["size"]
        by_source[x["source"]].append(x)
    total = sum(x["size"] for x in mixed)
    assert sum(rows[0]["target"] for rows in by_source.values()) == pytest.approx(1.5 * total)
    for rows in by_source.values():
        assert rows[0]["source_size"] == sum(x["size"] for x in rows)
        assert sum(x["taken"] for x in rows) == int(rows[0]["target"]) and rows[0]["target"] <= 2 * rows[0]["source_size"]
    copies = mixing.materialise(mixing.mix(docs, F.array("source"))).collect()
    whole = {x["doc_id"]: x["text"] for x in mixed}
    assert all(x["text"] == whole[x["doc_id"]] and x["copy"] <= 2 for x in copies)
    for source, rows in by_source.items():
        got = sum(len(words(x["text"])) for x in copies if x["source"] == source)
        assert abs(got - sum(x["taken"] for x in rows)) <= max(x["size"] for x in rows) / 2
    clash = docs.selectExpr("*", *(f"'mine' as _{c}" for c in ("pattern", "place", "passes", "low", "high", "left")))
    kept = mixing.mix(clash, F.array("source")).drop("size", "source_size", "target", "taken", "copies")
    assert set(kept.columns) == set(clash.drop("taken").columns) and kept.where("_left = 'mine' and _pattern = 'mine' and _place = 'mine'").count() == len(texts)
    assert mixing.mix(table(spark, []), F.array("source")).count() == 0


def test_targets_reshare_what_full_sources_leave():
    found = mixing.targets({"a": 10, "b": 1000, None: 1000})
    assert found["a"] == 20 and found["b"] == pytest.approx((3015 - 20) / 3) and found[None] == pytest.approx(2 * (3015 - 20) / 3)


def test_flow_prefers_first_uses():
    """An overlapping pattern serves the source that would have to repeat its words."""
    flows = mixing.route({("a",): 10, ("b",): 50, ("a", "b"): 30}, {"a": 40, "b": 50})
    assert sum(flows[p].get("a", 0) for p in flows) == 40 and sum(flows[p].get("b", 0) for p in flows) == 50
    assert flows[("a", "b")]["a"] == 30 and flows[("a",)]["a"] == 10 and flows[("b",)]["b"] == 50
    assert mixing.route({}, {}) == {}


def test_vectors(spark):
    r = np.random.Generator(np.random.PCG64(4))
    rows, base = [], r.normal(size=(12, 16))
    for i in range(150):
        rows.append((i, [float(x) for x in base[i % 12] + r.normal(size=16) * r.choice([0, 0.05, 0.12])], i % 3))
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [None] + [1.0] * 15, 0), (203, [float("nan")] * 16, 0), (204, rows[0][1], None), (205, [float("inf")] * 16, 1), (None, rows[0][1], 0), (3, rows[3][1], 0)]
    usable = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in usable}
    pairs = [(a, b) for a in usable for b in usable if a < b and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.98]
    low = least_reachable([x[0] for x in rows if x[0] is not None], [(rows[a][0], rows[b][0]) for a, b in pairs])
    links = collections.Counter(k for p in pairs for k in p)
    expected = sorted((str(i), links[k], str(low.get(i))) for k, (i, _, _) in enumerate(rows))
    found = near_vectors(table(spark, rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((str(x["vec_id"]), x["n_links"], str(x["component_id"])) for x in found) == expected
    assert near_vectors(table(spark, [], "vec_id long, embedding array<float>, label int")).count() == 0


def test_rotation_keeps_lengths():
    q = rotation(16, 3)
    assert np.allclose(q @ q.T, np.eye(16)) and (rotation(16, 3) == q).all()


def test_archive(spark, tmp_path):
    long = "<p>é</p>" * 200
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (3, None, "short"), (4, "http://b/4", "short"), (5, "http://b/5", None), (9, "http://b/9", long), (9, "u", long), (None, "u", long)]
    folder = Scratch(spark, "test").folder()
    warc.write_warc(warc.page_records(table(spark, rows, "page_id long, url string, html string")), folder)
    records = warc.read_warc(spark, folder)
    found = {(x["record_id"], x["target_uri"]): x for x in records.where("warc_type <> 'warcinfo'").collect()}
    assert len(found) == 8
    for i, url, html in rows:
        x = found[f"urn:x-page:{'none' if i is None else i}", url if url is None else url.replace("\r\n", "%0D%0A")]
        raw = (html or "").encode()
        revisit = html == long and i in (1, 2)
        assert (x["warc_type"], x["refers_to"]) == (("revisit", "urn:x-page:9") if revisit else ("response", None))
        assert x["payload_length"] == len(raw) and bytes(x["payload"]) == (b"" if revisit else raw)
        assert x["payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()
    picked = warc.read_warc(spark, folder, payload=False).where("warc_type = 'revisit' and target_uri like 'http://a/%'")
    assert sorted(x["record_id"] for x in picked.collect()) == ["urn:x-page:1", "urn:x-page:2"]
    assert {x["payload"] for x in picked.collect()} == {None}
    hexed = records.where("warc_type = 'revisit'").select(warc.base32_hex(F.substring_index("payload_digest", ":", -1))).distinct().collect()
    assert [x[0] for x in hexed] == [hashlib.sha1(long.encode()).hexdigest()]
    assert warc.read_warc(spark, f"{folder}-none").count() == 0


def test_archive_ranges(tmp_path, monkeypatch):
    """Ranges of any size give each record once, with and without the size field."""
    r = random.Random(5)
    blocks = [bytes(r.randrange(256) for _ in range(r.randint(0, 3000))) + b"\x1f\x8b\x08" for _ in range(40)]
    records = [warc.record_bytes({"WARC-Type": "resource" if i % 3 else "metadata", "WARC-Record-ID": f"<u:{i}>"}, b) for i, b in enumerate(blocks)]
    for plain in (False, True):
        import gzip

        whole = b"".join(gzip.compress(x) if plain else warc.member(x) for x in records)
        (tmp_path / "a.warc.gz").write_bytes(whole)
        for size in (700, 5000, len(whole)):
            got = []
            with fs.LocalFileSystem().open_input_file(str(tmp_path / "a.warc.gz")) as file:
                for a in range(0, len(whole), size):
                    got += [b for _, b in warc.records(file, a, min(a + size, len(whole)), lambda h: True)]
                assert got == blocks
                some = [h["warc-record-id"] for h, _ in warc.records(file, 0, len(whole), lambda h: h["warc-type"] == "metadata", payload=False)]
                assert some == [f"<u:{i}>" for i in range(0, 40, 3)]


def test_damaged_archives(spark, tmp_path):
    """A record without the end of its headers, one cut off, one with a broken byte: an error, or left out alone."""
    import gzip

    blocks = [f"block {i} ".encode() * 200 for i in range(6)]
    whole = [warc.record_bytes({"WARC-Type": "resource", "WARC-Record-ID": f"<u:{i}>"}, b) for i, b in enumerate(blocks)]
    for plain in (False, True):
        pack = gzip.compress if plain else warc.member
        members = [pack(x) for x in whole]
        broken = bytearray(members[3])
        broken[len(broken) // 2] ^= 0xFF
        cases = {
            "headers": [*members[:3], pack(b"WARC/1.1\r\nWARC-Type: resource\r\n"), *members[4:]],
            "byte": [*members[:3], bytes(broken), *members[4:]], "tail": [*members[:3], *members[4:], members[3][:-40]],
            "short": [*members[:3], pack(whole[3][:900]), *members[4:]],
        }
        for name, parts in cases.items():
            folder = tmp_path / f"{name}-{plain}"
            folder.mkdir()
            (folder / "a.warc.gz").write_bytes(b"".join(parts))
            with pytest.raises(Exception, match="is damaged"):
                warc.read_warc(spark, str(folder)).collect()
            left = warc.read_warc(spark, str(folder), damaged="skip").collect()
            assert sorted((r["record_id"], r["payload"]) for r in left) == [(f"u:{i}", blocks[i]) for i in (0, 1, 2, 4, 5)], (name, plain)


def test_token_files_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 500)
    docs = documents(spark, [f"some words of text {i} " * 5 for i in range(300)])
    token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "t"), partitions=6)
    assert token_files.read_tokens(spark, str(tmp_path / "t")).rdd.getNumPartitions() == 6
