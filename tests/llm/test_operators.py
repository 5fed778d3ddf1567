"""Operators against brute force on a small fixture with nulls, empties, ties and copies."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from taxarium.llm import chat, decontaminate, gif, language, licenses, mixing, neardup, repeats, simhash, suffixarray, suffixtree, tokens
from taxarium.llm.queries import op1_chat

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, fingerprint string, size long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeß") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    text = lambda n: rng.choice([" ", "\n", "  "]).join(rng.choice(vocabulary) for _ in range(n))
    passage = text(90)
    out = [(i, text(rng.choice([0, 1, 3, 60, 200])), "en", None if i % 7 == 0 else f"s{i % 3}", "x", 1) for i in range(30)]
    out += [(30 + i, f"{text(5)} {passage} {text(20 * i)}", "en", "s0", "x", 1) for i in range(6)]
    out += [(40 + i, passage, "en", "s0", "x", 1) for i in range(4)]
    out += [(50, None, None, None, None, None), (51, "", "en", "s1", "x", 1), (52, "ab " * 500, "en", "s1", "x", 1), (53, "\0 \t\r\n", "en", "s2", "x", 1), (54, "a" * 3000, "en", "s2", "x", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_suffix_trees(docs, rows):
    got, seen = by_id(suffixtree.dedup_words(docs)), {}
    for doc_id, text, *_ in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = np.zeros(len(w), bool)
        keys = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        for i, k in enumerate(keys):
            gone[i : i + 50] |= k in seen
        seen.update(dict.fromkeys(keys))
        assert got[doc_id]["kept"] == " ".join(x for x, g in zip(w, gone) if not g), doc_id


@pytest.mark.parametrize("most", [20_000, 3])
def test_suffix_trees_of_hot_prefixes(spark, monkeypatch, most):
    """Anchors with many contexts: longer prefixes, and groups of whole windows where those are still too large."""
    monkeypatch.setattr(repeats, "HOT", 4)
    monkeypatch.setattr(repeats, "MOST", most)
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(40)}"
    passages = [[word() for _ in range(n)] for n in (12, 30, 47, 60, 75)]
    texts = []
    for i in range(160):
        w = [word() for _ in range(rng.randrange(60))]
        for _ in range(rng.randint(1, 3)):
            cut = rng.choice(passages)
            w += cut[rng.randrange(3) :] + [rng.choice("xyz") for _ in range(rng.randrange(4))] + [word() for _ in range(rng.randrange(45))]
        texts.append((i, " ".join(w)))
    got, seen, gone_in_all = by_id(suffixtree.dedup_words(spark.createDataFrame(texts, "doc_id long, text string"))), {}, 0
    for doc_id, text in texts:
        w = text.split()
        gone = np.zeros(len(w), bool)
        keys = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        for i, k in enumerate(keys):
            gone[i : i + 50] |= k in seen
        seen.update(dict.fromkeys(keys))
        gone_in_all += int(gone.sum())
        assert got[doc_id]["kept"] == " ".join(x for x, g in zip(w, gone) if not g), doc_id
    assert gone_in_all > 1000


def test_suffix_arrays(docs, rows):
    got, seen = by_id(suffixarray.dedup_bytes(docs)), set()
    for doc_id, text, *_ in sorted(rows):
        t = (text or "").encode()
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(t[i : i + 100])
        assert bytes(got[doc_id]["kept"]) == np.frombuffer(t, np.uint8)[~gone].tobytes(), doc_id


def test_suffix_arrays_of_hot_anchors(spark, monkeypatch):
    """Anchors with many contexts in several shards: what shards leave as first is merged across them."""
    monkeypatch.setattr(repeats, "HOT", 4)
    rng = random.Random(13)
    noise = lambda n: "".join(rng.choice("ab\0ß") for _ in range(n))
    passages = [noise(n) for n in (30, 60, 90, 130, 200)]
    texts = []
    for i in range(200):
        t = noise(rng.randrange(80))
        for _ in range(rng.randint(1, 3)):
            t += rng.choice(passages)[rng.randrange(3) :] + rng.choice("xyz") * rng.randrange(3) + noise(rng.randrange(50))
        texts.append((i, t))
    got, seen, gone_in_all = by_id(suffixarray.dedup_bytes(spark.createDataFrame(texts, "doc_id long, text string"))), set(), 0
    for doc_id, text in texts:
        t = text.encode()
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(t[i : i + 100])
        gone_in_all += int(gone.sum())
        assert bytes(got[doc_id]["kept"]) == np.frombuffer(t, np.uint8)[~gone].tobytes(), doc_id
    assert gone_in_all > 1000


def test_merge_of_sorted_runs():
    """Shards' runs are sorted suffixes; merging by binary search finds the windows that another shard holds earlier."""
    kind, rng = suffixarray.KIND, random.Random(3)
    middle = bytes(rng.choice(b"\0a\xff") for _ in range(97))
    held, lots = [], {}
    for c in range(60):
        context = bytes(rng.choice(b"\0\xff") for _ in range(3)) + middle + bytes(rng.choice(b"\0\xff") for _ in range(3))
        held.append((0, c % 5, 5, 7, c, 0, c, 0, 0, len(context) - 99, context))
    gone = []
    for shard in range(5):
        for h, c, a, b, lot, data in repeats._shard(kind, suffixarray.window_groups, [r for r in held if r[1] == shard]):
            if data is None:
                gone += [(c, i) for i in range(a, b - 99)]
            else:
                run = np.frombuffer(data, repeats._left(kind))
                windows = [bytes(w).ljust(kind.span, b"\0") for w in run["w"].tolist()]
                assert windows == sorted(set(windows))
                lots.setdefault(lot, []).append(run)
    alone = len(gone)
    for runs in lots.values():
        gone += [(c, a) for h, c, a, b in repeats._merge(kind, 7, runs)]
    seen, expected = set(), []
    for row in held:
        for a in range(row[9]):
            w = row[10][a : a + 100]
            expected += [(row[4], a)] * (w in seen)
            seen.add(w)
    assert sorted(gone) == expected and 0 < alone < len(gone)


def test_repeated_ids_and_empty_table(spark, docs):
    twice = spark.createDataFrame([(1, "ab " * 80), (1, "ab " * 80), (None, "cd " * 80), (2, "cd " * 80)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in suffixtree.dedup_words(twice).collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (2, 80)]
    none = docs.limit(0)
    for op in (suffixtree.dedup_words, suffixarray.dedup_bytes, simhash.near_duplicates, mixing.mix, gif.text_media):
        assert op(none).count() == 0
    assert tokens.read_tokens(tokens.write_tokens(none)).count() == 0


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows):
    got = by_id(simhash.near_duplicates(docs))
    fp = {r[0]: brute_fingerprint(r[1]) for r in rows}
    label = {i: i for i in fp}
    for _ in fp:
        for i in fp:
            label[i] = min(label[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 3)
    for i in fp:
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fp[i]:016x}", label[i])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(label.values())


def test_golay_keys_meet():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 23, 500)
    keys = simhash.golay_keys(x)
    assert set((keys >= 0).sum(axis=1)) <= {1, 6}
    fp = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    for n in range(4):
        other = fp.copy()
        for _ in range(n):
            other ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
        a, b = simhash.fingerprint_keys(fp), simhash.fingerprint_keys(other)
        for i in range(200):
            assert set(a[1][a[0] == i]) & set(b[1][b[0] == i])


def test_tokens(docs, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path())
    got, start = by_id(tokens.read_tokens(tokens.write_tokens(docs))), 0
    for doc_id, text, *_ in sorted(rows):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"], got[doc_id]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 2, 17, 50_000, 2**33, 2**59, 2**63):
        v = rng.integers(0, top, 1000).astype(np.uint64)
        assert (tokens.unpack(tokens.pack(v)) == v).all()
    assert len(tokens.unpack(tokens.pack(np.empty(0, np.uint64)))) == 0


def test_gif(docs, rows):
    got = by_id(gif.media_digests(gif.text_media(docs)))
    for doc_id, text, *_ in rows:
        p = gif.pad((text or "").encode())
        assert (got[doc_id]["payload_sha256"], got[doc_id]["tail_crc32"]) == (hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    p = np.random.default_rng(2).integers(0, 9, 64 * 900).astype(np.uint8).tobytes()
    frame, = gif.decode_gif(gif.encode_gif(p))
    assert frame.indices.tobytes() == p and sum(frame.histogram()) == 3 * len(p)


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    by_source = {}
    for r in got:
        assert 0 <= r["copies"] <= 2
        by_source.setdefault(r["source"], []).append(r)
    for part in by_source.values():
        assert abs(sum(r["size"] * r["copies"] for r in part) - part[0]["target"]) <= 2 * max(r["size"] for r in part)
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_language_of_code_switched_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(table, per_lang=40)
    got = language.predict(table.select("doc_id", "lang", language.held_out().alias("h"), "text"), model).filter("h").select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ²³ !")], "doc_id long, text string")
    assert {r["lang_pred"] for r in language.predict(odd, model).collect()} == {"und"}


def test_decontamination_and_licenses(spark):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40))), (2, "only three words"), (3, None), (4, "")], "item_id long, text string")
    words = [f"w{i}" for i in range(40)]
    texts = [(1, "x y " + " ".join(words) + " z"), (2, " ".join(words[:20] + ["new"] + words[20:]).upper()), (3, " ".join(words[:15])), (4, "here only three words end"), (5, None), (6, " ".join(words[:38] + ["q", "r"]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.report(docs, bench).collect()}
    assert {(1, 1), (4, 2), (6, 1)} <= found and not {d for d, _ in found} & {3, 5}
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()} >= {3, 5}
    notices = spark.createDataFrame([(1, "a b c Released under the MIT License. d e"), (2, "Released under the"), (3, None)], "doc_id long, text string")
    assert [(r["doc_id"], r["template_id"]) for r in licenses.report(notices, licenses.templates(spark)).collect()] == [(1, "mit")]


def test_reply_tree(spark):
    rows = [(1, 0, None, 0.0, "user", "hi ### x"), (1, 1, 0, 1.0, "assistant", "a</turn>\n"), (1, 2, 0, 5.0, "assistant", None), (1, 3, 1, 9.0, "user", "\\b\\"), (1, 4, 9, 0.0, "user", "lost")]
    m = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    out = chat.format_paths(chat.reply_paths(spark, m, top_k=2), m)
    got = {r["leaf"]: r["t"] for r in out.select("leaf", chat.read_turns(out["formatted"]).alias("t")).collect()}
    assert set(got) == {3, 2}
    assert [tuple(t) for t in got[3]] == [("user", "hi ### x"), ("assistant", "a</turn>\n"), ("user", "\\b\\")]
    assert [tuple(t) for t in got[2]] == [("user", "hi ### x"), ("assistant", "")]
    control = {r["conv_id"]: r for r in op1_chat(spark, SF).collect()}[-7]
    assert (control["n_turns"], control["loss_chars"]) == (2, len("\\### Assistant: </turn> ok"))


def test_decontamination_at_the_edges(spark):
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    fill = [f"f{i}" for i in range(80)]
    texts = {
        1: words[1:], 2: words[:-1], 3: words[:30] + words[31:], 4: fill + words[:-1], 5: words[1:] + fill, 6: fill + words[:-3], 7: words[3:] + fill, 8: fill[:40] + words + fill[40:],
        9: words[:40], 10: fill + words[:40], 11: fill, 12: words[:1],
    }

    def similarity(w):
        grams = lambda x: {tuple(x[i : i + 5]) for i in range(len(x) - 4)}
        item, at = grams(words), range(max(1, len(w) - 59))
        return max(len(item & grams(w[i : i + 60])) / len(item | grams(w[i : i + 60])) for i in at)

    want = {d: similarity(w) for d, w in texts.items() if similarity(w) >= 0.8}
    assert set(want) == {1, 2, 3, 4, 5, 6, 7, 8}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(docs, bench).collect()}
    assert {d: r["similarity"] for d, r in got.items()} == pytest.approx(want)
    assert (got[1]["start_word"], got[1]["n_words"]) == (0, 59) and (got[4]["start_word"], got[4]["n_words"]) == (79, 60)
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()} == set(texts) - set(want)


def test_near_duplicates_by_jaccard(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    line, texts = " ".join(vocabulary[:12]), []
    for i in range(25):
        w = rng.choices(vocabulary, k=rng.choice([40, 90, 150]))
        texts += [" ".join(w), " ".join(w).upper() + "\n"]
        for edits in (1, 1, 2, 3, 4):
            for _ in range(edits if i % 2 else 1):
                w = [*w]
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
        texts.append(f"{line} " + " ".join(rng.choices(vocabulary, k=20)))
    texts += [None, "", " ", "a b", "A b", "a b c", line, line]
    rng.shuffle(texts)
    grams = []
    for t in texts:
        w = (t or "").lower().split()
        grams.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label, near = list(range(len(texts))), lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    edges = [(i, j) for i in label for j in range(i) if near(grams[i], grams[j])]
    for _ in texts:
        for i, j in edges:
            label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label))
    far = [(i, j) for i, j in edges if (brute_fingerprint(texts[i]) ^ brute_fingerprint(texts[j])).bit_count() > 3]
    assert far and {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()} == set(label)
    assert neardup.keep_first(docs.limit(0)).count() == 0
    shared = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "d e f"), (None, "g h i"), (None, "D e F")], "doc_id long, text string")
    assert sorted(r["text"] for r in neardup.keep_first(shared).collect()) == ["D e F", "a b c", "g h i"]


def test_short_notices_within_other_text(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**9)}"
    notice = dict(licenses.NOTICES)["mit"]
    texts = [(i, " ".join([*(word() for _ in range(12)), notice, *(word() for _ in range(12))])) for i in range(800)]
    got = licenses.report(spark.createDataFrame(texts, "doc_id long, text string"), licenses.templates(spark)).collect()
    assert sorted((r["doc_id"], r["template_id"], r["start_word"], r["containment"]) for r in got) == [(i, "mit", 10, 1.0) for i in range(800)]


def test_license_windows_by_join(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(100).unionByName(spark.createDataFrame([(-1, f"a b c d {licenses.NOTICES[4][1]} e"), (-2, f"x {licenses.NOTICES[1][1]}"), (-3, None)], "doc_id long, text string"), allowMissingColumns=True)
    rows = lambda: sorted(map(tuple, licenses.report(docs, licenses.templates(spark)).collect()))
    in_place = rows()
    monkeypatch.setattr(licenses, "PLAN_SHINGLES", 0)
    assert {r[0] for r in in_place} >= {-1, -2} and rows() == in_place
