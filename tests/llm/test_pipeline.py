"""The pipeline's stages and the operators' edges against plain versions on small tables."""

import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

import corpus_pipeline
from taxarium.llm import chat, decontaminate, gif, language, licenses, mixing, neardup, simhash, tokens
from taxarium.llm.queries import op1_chat, op2_gif

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def grams(w, k=5):
    w = [x.lower() for x in w]
    return [tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]


def weighted(a, b):
    from collections import Counter

    a, b = Counter(a), Counter(b)
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def leaks(texts, items):
    """{(doc, item): (similarity, last best start)} over every window."""
    out = {}
    for (d, t), (i, q) in product(texts.items(), items.items()):
        w, v = words(t), words(q)
        if not w or not v or len(w) < min(5, len(v)):
            continue
        k = min(5, len(v))
        want = grams(v, k)
        found = [(weighted(grams(w[s : s + len(v)], k), want), s) for s in range(max(1, len(w) - len(v) + 1))]
        if max(found)[0] >= 0.8:
            out[d, i] = max(found)
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = (docs.collect(), (docs := spark.read.parquet(path)).collect(), docs.columns)
    return out


def test_pipeline_languages(spark, stages):
    before, after, columns = stages["language_id"]
    assert columns == spark.read.parquet(f"{SF}/documents.parquet").columns
    tagger = language.Tagger(language.fit(spark.read.parquet(f"{SF}/documents.parquet")))
    sure = tagger.documents([None if r["text"] is None else r["text"].encode() for r in before])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, (lang, _, s) in zip(before, sure) if lang != "und" and s >= 0.5}


def test_pipeline_near_duplicates(stages):
    before, after, _ = stages["near_dedup"]
    sets = {r["doc_id"]: frozenset(grams(words(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")))) for r in before}
    label = {d: d for d in sets}
    ids = sorted(sets)
    close = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in close:
            label[a] = label[b] = min(label[a], label[b])
    assert {r["doc_id"] for r in after} == set(label.values())


def test_pipeline_decontamination(spark, stages):
    before, after, _ = stages["decontamination"]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    held = {g for t in items.values() for g in grams(words(t))}
    texts = {r["doc_id"]: r["text"] for r in before if held & set(grams(words(r["text"])))}
    gone = {d for d, _ in leaks(texts, items)}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - gone


def test_pipeline_mixture_and_tokens(stages):
    before, after, _ = stages["mixture"]
    copies = {}
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    sizes = {r["doc_id"]: (r["source"], len(words(r["text"]))) for r in before}
    totals = {}
    for source, n in sizes.values():
        totals[source] = totals.get(source, 0) + n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    targets, left, rest = {}, 1.5 * sum(totals.values()), set(order)
    while rest:
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        full = {s for s in rest if share[s] > 2 * totals[s]}
        if not full:
            targets |= share
            break
        targets |= {s: 2 * totals[s] for s in full}
        left, rest = left - sum(2 * totals[s] for s in full), rest - full
    for s in order:
        taken = sum(n * copies.get(d, 0) for d, (source, n) in sizes.items() if source == s)
        assert abs(taken - targets[s]) <= 2 * max(n for source, n in sizes.values() if source == s)
    assert max(copies.values()) <= 2
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = True
    before, after, _ = stages["token_output"]
    want, start = [], 0
    for r in sorted(before, key=lambda r: (r["doc_id"], r["text"])):
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in after) == sorted(want)


def test_clashing_names(spark):
    names = ["_source", "_class", "_spread", "__size", "__rank", "__copy", "__id", "__x", "__i", "__t", "__first", "__order", "row", "_id", "_x", "lang_pred", "score", "_found", "a b`c"]
    texts = [" ".join(f"w{i}{j}" for j in range(30)) for i in range(4)]
    rows = [(i, t, "en", "s", len(t or ""), *(f"{n}{i}" for n in names)) for i, t in enumerate([*texts, texts[0], None, ""])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    bench = spark.createDataFrame([(1, texts[1])], "item_id long, text string")
    whole = {r["doc_id"]: tuple(r) for r in docs.collect()}
    for op, kept in (
        (mixing.mixed_rows, None), (lambda d: decontaminate.without_leaks(d, bench), {0, 2, 3, 4, 5, 6}), (simhash.keep_first, {0, 1, 2, 3, 5}), (neardup.keep_first, {0, 1, 2, 3, 5}), (language.keep_known, {0, 1, 2, 3, 4}),
    ):
        got = op(docs)
        found = got.collect()
        assert got.columns == docs.columns and all(tuple(r) == whole[r["doc_id"]] for r in found)
        assert kept is None or {r["doc_id"] for r in found} == kept


def test_empty_tables_and_long_texts(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for _, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:]:
        assert stage(spark, none, SF).count() == 0
    assert decontaminate.report(none, items).count() == decontaminate.report(none, items.limit(0)).count() == decontaminate.without_leaks(none, items).count() == 0
    assert licenses.report(none, licenses.templates(spark)).count() == gif.media_digests(gif.text_media(none)).count() == language.language_of(none).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    messages = chat.conversation_messages(turns)
    assert chat.format_paths(chat.reply_paths(spark, messages), messages).count() == 0
    long = spark.createDataFrame([(1, "word and another " * 60_000, "en", "s", 0), (2, "x" * 5_000_000, "en", "s", 0), (3, "word and another " * 60_000, None, None, 0)], DOCS)
    (m,) = gif.media_digests(gif.text_media(long.filter("doc_id = 2"))).collect()
    assert (m["payload_bytes"], m["payload_sha256"], m["feature"][:6]) == (5_000_000, hashlib.sha256(b"x" * 5_000_000).hexdigest(), "gif:2x")
    assert {r["doc_id"] for r in neardup.keep_first(long).collect()} == {1, 2}
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.read_tokens(tokens.write_tokens(long.filter("doc_id <> 2"))).collect()} == {1: 180_002, 3: 180_002}
    item = spark.createDataFrame([(5, "word and another " * 10)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.report(long, item).collect()) == [1, 3]


def test_windows_anywhere(spark):
    w = [f"w{i}" for i in range(40)]
    fill = [f"f{i}" for i in range(60)]
    texts = {1: w[3:] + fill, 2: fill + w[:-3], 3: w[20:] + w[:20], 4: fill[:9] + w[20:] + w[:20] + fill, 5: w[:37] + fill, 6: fill, 7: w + fill + w, 8: w[:30] + fill[:4] + w[30:]}
    bench = {1: " ".join(w), 2: "one two", 3: " ".join(w[:20] * 2)}
    plain = leaks({d: " ".join(t) for d, t in texts.items()}, bench)
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (7, 1)} <= set(plain)
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string")
    got = decontaminate.report(docs, spark.createDataFrame(list(bench.items()), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (pytest.approx(r["similarity"]), r["start_word"]) for r in got} == plain


def test_recall_at_the_threshold(spark):
    """Copies altered down to a similarity of 0.8, of items of different length."""
    rng = random.Random(11)
    items, docs = {}, {}
    for i in range(60):
        n = rng.choice([20, 40, 80, 160])
        items[i] = " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
        for c in range(5):
            w = items[i].split()
            while weighted(grams(w), grams(items[i].split())) > 0.87:
                w[rng.randrange(n)] = f"z{rng.randrange(10**6)}"
            docs[i * 10 + c] = " ".join(["pre"] * rng.randrange(9) + w + ["post"] * rng.randrange(9))
    plain = {(d, d // 10) for d, t in docs.items() if leaks({d: t}, {d // 10: items[d // 10]})}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.report(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got <= plain and len(got) >= 0.99 * len(plain) and len(plain) > 150


def plain_lzw(data, bits):
    """A decoder by the book, bit by bit."""
    stream = "".join(f"{b:08b}"[::-1] for b in data)
    clear, out, at, width, table, last = 1 << bits, [], 0, bits + 1, {}, None
    while True:
        code, at = int(stream[at : at + width][::-1], 2), at + width
        if code == clear:
            table, width, last = {i: [i] for i in range(clear)}, bits + 1, None
            following = clear + 2
            continue
        if code == clear + 1:
            return bytes(v for e in out for v in e)
        entry = table[code] if code in table else last + last[:1]
        if last is not None and following < 4096:
            table[following] = last + entry[:1]
            following += 1
            if following == 1 << width and width < 12:
                width += 1
        out.append(entry)
        last = entry


def test_lzw_streams():
    rng = np.random.default_rng(4)
    for n, top in ((1, 2), (70, 4), (3000, 3), (30_000, 256), (60_000, 2)):
        data = rng.integers(0, top, n).astype(np.uint8).tobytes()
        stream = gif.lzw_encode(data)
        assert plain_lzw(stream, 8) == data == gif.lzw_decode(stream, 8, n).tobytes()
    small = rng.integers(0, 4, 500).astype(np.uint8).tobytes()
    assert gif.lzw_decode(gif.lzw_encode(small, 2), 2, 500).tobytes() == small == plain_lzw(gif.lzw_encode(small, 2), 2)
    with pytest.raises(ValueError):
        gif.lzw_decode(bytes([0b00000100, 0b11111110, 255, 255]), 2, 9)


def test_foreign_gif(spark):
    """Local palettes, transparency, interlacing and each disposal, against a canvas kept by hand."""
    palette = bytes([255, 0, 0, 0, 255, 0, 0, 0, 255, 9, 9, 9])
    local = bytes([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12])
    u16 = lambda v: v.to_bytes(2, "little")

    def frame(left, top, w, h, pixels, disposal=0, clear=None, own=False, interlaced=False, delay=5):
        control = b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None)]) + u16(delay) + bytes([clear or 0, 0])
        rows = [pixels[y * w : (y + 1) * w] for y in range(h)]
        if interlaced:
            rows = [rows[y] for s, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(s, h, step)]
        head = b"\x2c" + u16(left) + u16(top) + u16(w) + u16(h) + bytes([(0x81 if own else 0) | (0x40 if interlaced else 0)]) + (local if own else b"")
        stream = gif.lzw_encode(b"".join(rows), 2)
        return control + head + b"\x02" + b"".join(bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255)) + b"\0"

    rng = np.random.default_rng(9)
    draw = lambda n: rng.integers(0, 4, n).astype(np.uint8).tobytes()
    shapes = [(0, 0, 12, 10, 0, None, False, True), (2, 1, 5, 5, 2, 1, False, False), (4, 4, 6, 3, 3, 2, True, False), (0, 0, 12, 10, 1, 3, False, False)]
    frames = [(s, draw(s[2] * s[3])) for s in shapes]
    data = b"GIF89a" + u16(12) + u16(10) + b"\x81\0\0" + palette + b"\x21\xfe\x03abc\0"
    data += b"".join(frame(*s[:4], p, s[4], s[5], s[6], s[7]) for s, p in frames) + b";"
    canvas = [[(0, 0, 0, 0)] * 12 for _ in range(10)]
    for got, ((left, top, w, h, disposal, clear, own, _), pixels) in zip(gif.decode_gif(data), frames, strict=True):
        colours = local if own else palette
        before = [list(r) for r in canvas]
        for y, x in product(range(h), range(w)):
            v = pixels[y * w + x]
            if v != clear:
                canvas[top + y][left + x] = (*colours[3 * v : 3 * v + 3], 255)
        assert got.canvas.tolist() == [[list(v) for v in r] for r in canvas]
        seen = [v for r in canvas for v in r if v[3]]
        assert got.histogram() == [sum(v[c] // 32 == b for v in seen) for c in range(3) for b in range(8)]
        if disposal == 2:
            for y, x in product(range(h), range(w)):
                canvas[top + y][left + x] = (0, 0, 0, 0)
        elif disposal == 3:
            canvas = before
    media = spark.createDataFrame([(1, data), (2, b"GIF89a"), (3, None)], "doc_id long, media binary")
    rows = gif.gif_frames(media).collect()
    assert [(r["frame"], r["start_cs"]) for r in rows if r["doc_id"] == 1] == [(0, 0), (1, 5), (2, 10), (3, 15)]


def test_op2_whole_table(spark):
    got = {r["doc_id"]: r for r in op2_gif(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        raw = (r["text"] or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        stored = gif.encode_gif(p)
        hist = ",".join(str(sum(v // 32 == b for v in p)) for b in range(8))
        assert tuple(got[r["doc_id"]]) == (
            r["doc_id"], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), f"gif:1x64x{len(p) // 64}:10cs:{hist},{hist},{hist}",
        )


def test_op1_whole_table(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"] or "") for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-7, i, role, "\\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))]
    plain = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        plain.setdefault(c, []).append((role, text))
    got = {r["conv_id"]: r for r in op1_chat(spark, SF).collect()}
    assert set(got) == set(plain)
    for c, turns in plain.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        want = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == want


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(2)
    n, lengths = 3, np.array([1, 4, 7])
    emission, step = rng.random((lengths.sum(), n)) + 0.1, np.exp(rng.normal(size=(n, n)))
    starts = np.cumsum(lengths) - lengths
    got, pairs = language.forward_backward(emission, starts, lengths, step, pairs=True)
    expected = np.zeros((n, n))
    for s, k in zip(starts, lengths):
        at, both, total = np.zeros((k, n)), np.zeros((n, n)), 0.0
        for y in product(range(n), repeat=int(k)):
            p = np.prod([emission[s + i, y[i]] for i in range(k)]) * np.prod([step[y[i], y[i + 1]] for i in range(k - 1)])
            total += p
            for i in range(k):
                at[i, y[i]] += p
            for a, b in zip(y, y[1:]):
                both[a, b] += p
        assert np.allclose(got[s : s + k], at / total)
        expected += both / total
    assert np.allclose(pairs, expected)
    for piece in (1, 2, 3):
        begin, size, chain = language.in_pieces(lengths, piece)
        entering, leaving = language.messages(emission, begin, size, chain, step)
        assert np.allclose(language.forward_backward(emission, begin, size, step, entering=entering, leaving=leaving)[0], got)


def test_words_of_code_switched_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(table, per_lang=40)
    rows = table.filter(language.held_out() & table["lang"].isNotNull() & table["text"].isNotNull()).select("doc_id", "lang", "text").collect()
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).extend(c for c in language.chains(r["text"]) if len(c) >= 12)
    rng, mixed, gold = random.Random(3), [], {}
    for d in range(40):
        parts = [(lang, rng.choice(by_lang[lang])[:12]) for lang in rng.sample(sorted(by_lang), 2)]
        gold[d] = [(lang, w) for lang, c in parts for w in c]
        mixed.append((d, " ".join(w for _, w in gold[d])))
    docs = spark.createDataFrame([*mixed, (99, None), (98, "12 !")], "doc_id long, text string")
    found = {}
    for r in sorted(language.label_words(docs, model).collect(), key=lambda r: (r["doc_id"], r["line"], r["place"])):
        found.setdefault(r["doc_id"], []).append((r["lang"], r["word"]))
    assert set(found) == set(gold) and all([w for _, w in found[d]] == [w for _, w in gold[d]] for d in gold)
    right = [a == b for d in gold for (a, _), (b, _) in zip(found[d], gold[d])]
    assert sum(right) >= 0.85 * len(right)
    many = spark.createDataFrame([(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}xq " * 20, f"l{i % 90:02d}") for i in range(900)], "doc_id long, text string, lang string")
    assert len(language.fit(many, per_lang=5).langs) >= 85
