"""Corpus operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import chat, languages, lm, packing, pieces, quality, shards, simhash, substrings, topk
from fareloom.llm.common import crc_fold
from fareloom.llm.queries import PIECE_MODEL, WORD_TOKENIZER, tokenizer_path
from tests.llm.conftest import prose


def test_shards_cover_rows_and_grow_into_the_new_one(docs, no_docs, texts):
    rows = shards.assign_shards(docs, [1.0] * 5, [1.0] * 6).collect()
    assert len(rows) == len(texts) + 1
    slots = defaultdict(list)
    for row in rows:
        content = (texts[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(content) + 16, zlib.crc32(content))
        assert row.grown_shard in (row.shard, 5)
        slots[row.shard].append(row.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert shards.assign_shards(no_docs, [1.0]).count() == 0
    with pytest.raises(ValueError):
        shards.costs(F.col("doc_id"), [0.0])


def test_shards_follow_weights(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    found = Counter(r.shard for r in shards.assign_shards(rows, [1.0, 3.0]).collect())
    assert 0.72 < found[1] / 6000 < 0.78


def test_quality_counts(docs, no_docs, texts):
    for row in quality.judge(docs).collect():
        text = texts[row.doc_id] or ""
        words = text.encode().split()
        seen = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {
            i + k
            for i in range(len(words) - 2)
            if seen[tuple(words[i : i + 3])] > 1
            for k in range(3)
        }
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert row.n_words == len(words)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_repeat_words == len(covered)
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row.base_failed and row.kept)
    assert quality.judge(no_docs).count() == 0


def test_quality_rejects_texts_far_from_all_references(spark):
    rows = [(i, prose(i, 120), "xx") for i in range(40)]
    rows.append((99, " ".join("#%&*" * 3 for _ in range(30)) + " " + " ".join(f"9{i}9" for i in range(60)), "xx"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.judge(frame).collect()}
    assert not kept[99] and all(kept[i] for i in range(40))


def test_quality_keeps_small_languages(spark):
    cyrillic = str.maketrans("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувшхыз")
    rows = [(i, prose(i, 120), "xx") for i in range(40)]
    rows += [(100 + i, prose(i, 120).translate(cyrillic), "yy") for i in range(quality.LEAST_TEXTS - 1)]
    # More languages than were once compared; and a far text of unknown language.
    rows += [(1000 + i, prose(i, 60), f"l{i // 20:03}") for i in range(20 * 201)]
    rows += [(10_000 + i, prose(i, 120).translate(cyrillic), "zz") for i in range(quality.LEAST_TEXTS)]
    rows += [(20_000, " ".join(f"#%&*{i}" for i in range(90)), None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = quality.judge(frame)
    lost = {r.doc_id for r in judged.where(~F.col("kept") & ~F.col("base_failed")).select("doc_id").collect()}
    assert lost == {20_000}


def _fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(nodes, linked) -> dict:
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if root[a] != root[b] and linked(a, b):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_simhash_components(docs, no_docs, texts):
    prints = {i: _fingerprint(t) for i, t in texts.items()}
    expected = _roots(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == expected[row.doc_id]
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, 1000 + i) for i in range(50)] + [(7, 9), (8, 9)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(101, 161))
    assert all(found[1000 + i] == 1 for i in range(50))
    assert found[8] == found[9] == 7


def test_simhash_keys_that_are_null(spark):
    rows = [(None, "a text of no id"), (None, "one two three four"), (7, "one two three four")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == [(7, 7), (None, 7), (None, None)]


def test_near_dedup_keeps_one_of_each_group(spark, docs, texts):
    import corpus_pipeline

    prints = {i: _fingerprint(t) for i, t in texts.items()}
    roots = _roots(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(roots.values())
    assert {30, 31, 33} & set(roots.values()) == set()


def test_a_passage_in_unlike_texts_links_nothing(spark):
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [(i, f"{passage} " + " ".join(f"w{i}x{k}" for k in range(160))) for i in range(200)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(0, 200, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    prints = {i: _fingerprint(t) for i, t in rows}
    roots = _roots(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()} == roots


def test_removed_windows(docs, no_docs, texts):
    first: dict[tuple, int] = {}
    words = {i: (t or "").encode().split() for i, t in sorted(texts.items())}
    for i, found in words.items():
        for k in range(len(found) - 12):
            first.setdefault(tuple(found[k : k + 13]), i)
    for row in substrings.remove_repeats(docs).collect():
        found = words[row.doc_id]
        gone = {
            k + j
            for k in range(len(found) - 12)
            if first[tuple(found[k : k + 13])] < row.doc_id
            for j in range(13)
        }
        assert (row.n_words, row.n_removed) == (len(found), len(gone))
        assert row.kept_text == b" ".join(w for k, w in enumerate(found) if k not in gone).decode()
        assert {k for span in row.removed for k in range(span.start, span.end)} == gone
    assert substrings.remove_repeats(no_docs).count() == 0


def test_pieces_decode_to_the_text(docs, no_docs, texts):
    import sentencepiece

    path = tokenizer_path(PIECE_MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = pieces.encode_documents(docs, path, dropout=0.0)
    for row in plain.collect():
        text = texts[row.doc_id]
        if text is None:
            assert row.ids is None
        elif "▁" not in text:
            assert row.ids == model.encode(text)
    one, same, other = (pieces.encode_documents(docs, path, seed=s) for s in (1, 1, 2))
    assert {r.doc_id: r.text for r in pieces.decode_documents(one, path).collect()} == texts
    by_id = [{r.doc_id: r.ids for r in f.collect()} for f in (one, same, other)]
    assert by_id[0] == by_id[1] != by_id[2]
    assert all(r.lossless for r in pieces.encode_and_check(docs, path).collect())
    assert pieces.encode_documents(no_docs, path).count() == 0


def test_long_runs_are_segmented_alike():
    model = pieces.load(tokenizer_path(PIECE_MODEL))
    for run in ("▁" + prose(i, 6).replace(" ", "") for i in range(30)):
        flags = pieces.skips(np.array([5], np.uint64), 0, pieces.MOST_STEPS, 0.2)[0]
        skipped = sum(1 << i for i in np.flatnonzero(flags).tolist())
        assert model.segment_long(run[:60], 5, 0.2) == model.segment(run[:60], skipped)[1]


def test_a_character_is_looked_up_once_and_ids_are_decoded_together(monkeypatch):
    model = pieces.PieceModel(tokenizer_path(PIECE_MODEL))
    looked_up: list[str] = []

    class Counting(pieces._Numbers):
        def __getitem__(self, char):
            looked_up.append(char)
            return super().__getitem__(char)

    monkeypatch.setattr(pieces, "ENTRIES", 50)
    model.number.__class__ = Counting
    content = " ".join(["the quick ¤ 日本 fox", "ox x\u00e9", "the fox"] * 40)
    for dropout in (0.0, 0.5):
        ids = model.encode(content, 3, dropout)
        assert model.decode(ids) == model.decode(np.array(ids)) == content
        assert b"".join(model.bytes_of[i] for i in ids).decode().removeprefix(" ") == content
    assert model.decode([]) == ""
    assert len(looked_up) == len(set(looked_up)) > 10


def test_runs_of_all_texts_step_together(texts, monkeypatch):
    model = pieces.PieceModel(tokenizer_path(PIECE_MODEL))
    monkeypatch.setattr(model, "segment", None)
    contents = [*(t or "" for t in texts.values()), "a▁b  c ▁ ", "🙂é\n🙂ᚠ x", "long" * 30 + " ends"]
    keys = [xxhash.xxh64_intdigest(b"%d" % i) for i in range(len(contents))]
    found = [x.tolist() for x in model.encode_all(contents, keys, 0.3)]
    monkeypatch.undo()
    for text, key, ids in zip(contents, keys, found, strict=True):
        expected: list[int] = []
        place = 0
        for run in pieces.runs_of(text):
            if not run:
                expected += model._spelled("▁")
                continue
            own = int(pieces._mixed(np.array([place], np.uint64) + np.uint64(key))[0])
            flags = np.flatnonzero(pieces.skips(np.array([own], np.uint64), 0, pieces.MOST_STEPS, 0.3)[0]).tolist()
            expected += model.segment(run, sum(1 << i for i in flags))[1]
            place += 1
        assert ids == expected and model.decode(ids) == text
    # Whether runs are remembered or not changes nothing.
    monkeypatch.setattr(pieces, "REMEMBERED", 1)
    assert found == [model.encode(t, k, 0.3) for t, k in zip(contents, keys, strict=True)]


def test_conversations_read_back(spark):
    said = ["", "\\", "</s>[INST] ok [/INST]", "a\\</s>", "<<SYS>> x", "[[INST] <s", "é\n"]
    rows = [(1, i, role, t) for i, (role, t) in enumerate(zip("user assistant system tool user assistant user".split(), said, strict=True))]
    rows += [(2, 0, "assistant", said[2]), (3, 0, "user", None), (4, 0, None, "x"), (4, 0, None, "x"), (None, 0, "assistant", "n")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, example string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_examples(frame)).collect()}
    turns = defaultdict(list)
    for conv, _, role, text in rows:
        turns[conv].append((role or "", text or ""))
    assert set(got) == set(turns)
    for conv, listed in turns.items():
        content = "".join(f"{role}\n{text}\n" for role, text in listed)
        loss = "".join(text for role, text in listed if role == "assistant")
        assert got[conv].n_turns == len(listed)
        assert got[conv].turns_sha256 == hashlib.sha256(content.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.format_examples(frame).where("conv_id = 1").collect()
    assert [e.target_turn for e in examples] == [1, 5, None]
    assert chat.read_back(chat.format_examples(frame.limit(0))).count() == 0


def test_packing_is_whole_and_tight(docs, no_docs, texts):
    from tokenizers import Tokenizer

    path = tokenizer_path(WORD_TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, capacity=256).collect()
    by_doc = defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
    for i, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected = [(k // 256, k, zlib.crc32(np.array(ids[k : k + 256], "<u4").tobytes())) for k in range(0, len(ids), 256)]
        assert {(r.piece, r.start, r.ids_crc32) for r in by_doc[i]} == set(expected)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for found in sequences.values():
        ends = 0
        for offset, length in sorted(found):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert packing.pack(no_docs, path).count() == 0


def test_words_reach_the_tokenizer_together(texts):
    from tokenizers import Tokenizer

    path = tokenizer_path(WORD_TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    odd = ["İs ΑΣ É é e\u0301 ẞ ß don't DON'T 's </w> a</w> <|x|>,y", "aB-c ÀÖ×÷ÿ x1 2y ª", *(t or "" for t in texts.values())]
    assert encoder.encode(odd) == [
        np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd
    ]
    given: list[str] = []

    class Told:
        def encode_batch_fast(self, chunks, add_special_tokens):
            given.extend(chunks)
            return tokenizer.encode_batch_fast(chunks, add_special_tokens=add_special_tokens)

    encoder.tokenizer = Told()
    words = ["Word" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(1000)]
    encoder.encode([" ".join(words), " ".join(words).upper()])
    assert len(given) <= 1000 // packing.JOINED_WORDS + 1


def test_best_fit_equals_the_greedy_algorithm():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 65, 200)
        gaps: list[int] = []
        for size in sorted(sizes, reverse=True):
            fits = [g for g in gaps if g >= size]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - size)
            else:
                gaps.append(64 - size)
        places = packing.best_fit(dict(Counter(sizes.tolist())), 64)
        assert (places[:, 3] + places[:, 2]).max() == len(gaps)
        assert places[:, 2].sum() == 200


def test_languages_on_held_out_rows(spark, no_docs):
    german = "der die und den von zu das mit sich auf".split()
    rows = [(i, prose(i, 40), "en") for i in range(60)]
    rows += [(100 + i, " ".join(german[(i * k) % 10] + "chen" * (k % 3 == 0) for k in range(40)), "de") for i in range(60)]
    rows += [(900, None, "en"), (901, "12 34 !", "de"), (902, "theth andunseen ofthe", None), (903, "", None), (904, "12½ ² Ⅷ", None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    held = crc_fold(F.col("doc_id"), 3) == 1
    got = {r.doc_id: r for r in languages.identify(frame, ~held).collect()}
    assert all(got[i].lang_pred == "en" for i in range(60)) and all(got[100 + i].lang_pred == "de" for i in range(60))
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 904)] == ["und", "und", "en", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert languages.identify(no_docs, F.lit(True)).count() == 0
    assert {r.lang_pred for r in languages.identify(frame, F.lit(False)).collect()} == {"und"}


def test_unseen_words_are_scored_together(texts):
    rng = np.random.default_rng(2)
    known = {w: i for i, w in enumerate("the of and".split())}
    marked = "".join(f"<{w}>" for t in texts.values() for w in (t or "").lower().split()[:40])
    found = dict.fromkeys(marked[i : i + n] for n in (1, 2, 3, 4) for i in rng.integers(0, len(marked) - 4, 60))
    grams = {g: len(known) + i for i, g in enumerate(found)}
    weights = -rng.random((len(known) + len(grams), 3))
    detector = languages.Detector(["a", "b", "c"], known, grams, weights)

    def scored(word: str) -> np.ndarray:
        if word in known:
            return weights[known[word]]
        text, total = f"<{word}>", np.zeros(3)
        for i in range(len(text)):
            rows = [(n, grams[text[i : i + n]]) for n in (4, 3, 2, 1) if i + n <= len(text) and text[i : i + n] in grams]
            total += weights[rows[0][1]] + languages.BACKOFF * (4 - rows[0][0]) if rows else languages.UNSEEN
        return total / len(text) + 4 * languages.BACKOFF

    words = ["the", "", "x" * 90, "é", *{w for t in texts.values() for w in (t or "").lower().split()}]
    assert np.allclose(detector.word_scores(words), [scored(w) for w in words], rtol=1e-12)
    calls: list[int] = []
    detector.word_scores = lambda ws, score=detector.word_scores: calls.append(len(ws)) or score(ws)
    contents = [*(t or "" for t in texts.values()), "of-the_x qq-ww"]
    together = list(detector.predict_all(contents))
    assert len(calls) == 1
    detector.forget()
    assert together == [detector.predict(t) for t in contents]


def test_language_model_scores(docs, no_docs, texts):
    held = crc_fold(F.col("doc_id"), 7) == 2
    rows = lm.score(docs, held).collect()
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    repeats = Counter(r.doc_id for r in rows)
    counts: Counter = Counter()
    for i, found in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for _ in range(repeats[i]):
                counts.update(found)
    total, types = sum(counts.values()), len(counts)
    better = []
    for row in rows:
        found = tokens[row.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in found)
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        assert (row.n_tokens, row.train_tokens) == (len(found), total)
        assert row.n_known == sum(counts[w] > 0 for w in found)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0
        better.append(row.score - row.base_score)
    assert sum(better) > 0
    assert lm.score(no_docs, held).count() == 0


def test_every_word_is_a_context_of_its_own(spark):
    # More words than any small number of restaurants: each is followed by one of its own.
    n, repeats = 1500, 4
    rows = [(i, f"a{i} b{i} " * repeats, False) for i in range(n)]
    others = {i: (i + 1) % n for i in range(n)}
    rows += [(10_000 + i, f"a{i} b{i}", True) for i in range(n)] + [(20_000 + i, f"a{i} b{j}", True) for i, j in others.items()]
    # Words that a hash to 1,024 contexts would take for one.
    slots: dict[int, int] = {}
    same = []
    for i in range(n):
        j = slots.setdefault(xxhash.xxh64_intdigest(f"a{i}".encode()) % 1024, i)
        if j != i:
            same.append((i, j))
            rows.append((30_000 + i, f"a{i} b{j}", True))
    frame = spark.createDataFrame(rows, "doc_id long, text string, out boolean")
    scores = {r.doc_id: r.score for r in lm.score(frame, F.col("out")).collect()}
    assert len(scores) == len(rows) and len(same) > 300
    for i, _ in same:
        # The tokens around are alike, so a follower of another context is as unlikely as any.
        assert scores[10_000 + i] - scores[30_000 + i] > 1
        assert scores[30_000 + i] == pytest.approx(scores[20_000 + i], abs=0.5)


def test_tables_of_contexts_are_added_up_over_all_buckets(docs, texts):
    pairs: Counter = Counter()
    for row in docs.collect():
        found = [xxhash.xxh64_intdigest(w) for w in (row.text or "").encode().lower().split()]
        pairs.update(zip([*found, int(lm.END)], [int(lm.END), *found], strict=True))
    entries = lm.learn(docs, 16)
    types = entries.agg(F.sum("n_types")).first()[0]
    assert types == len({w for w, _ in pairs})
    of_bucket = {r["_bucket"]: r for r in entries.collect()}
    assert len(of_bucket) > 8
    for told, seats, root_seats in lm.seatings(entries, 16, types):
        tables, in_context, counts, customers, opened = Counter(), {}, {}, Counter(), {}
        for row in told.where("_from = -1").collect():
            own = of_bucket[row["_bucket"]]
            words, contexts = (lm._unpacked(own[name], "<u8").tolist() for name in ("words", "contexts"))
            word = np.repeat(words, lm._unpacked(own["sizes"], "<u4"))
            context = [contexts[i] for i in lm._unpacked(own["places"], "<u4")]
            in_context |= dict(zip(words, lm._unpacked(row["in_context"], "<u8").tolist(), strict=True))
            opened |= dict(zip(words, lm._unpacked(row["opened"], "<u4").tolist(), strict=True))
            seated = lm._unpacked(row["tables"], "<u4").tolist()
            for w, u, c, t in zip(word.tolist(), context, lm._unpacked(own["counts"], "<u4").tolist(), seated, strict=True):
                assert 1 <= t <= c
                counts[w, u] = c
                tables[u] += t
                customers[w] += t
        assert counts == pairs and in_context == tables
        assert (seats, root_seats) == (sum(customers.values()), sum(opened.values()))
        assert all(1 <= opened[w] <= customers[w] for w in customers)


def test_reseating_keeps_to_the_bounds():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 2, 5, 64, 65, 4000])
    tables = lm.draw_tables(counts, np.full(7, 10.0), np.full(7, 0.01), 0.7, 5.0, rng)
    assert (tables <= counts).all() and (tables[counts > 0] >= 1).all() and tables[0] == 0
    # Two customers of a dish share a table or not: the odds are known.
    pairs = lm.draw_tables(np.full(20000, 2), np.full(20000, 10.0), np.full(20000, 0.1), 0.5, 5.0, rng)
    new = (5.0 + 0.5 * 11) * 0.1
    assert abs((pairs == 2).mean() - new / (new + 0.5)) < 0.02


def test_topk_is_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(700)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(40)] + [(2000, [1.0, 2.0])]
    bad = [(5000, None), (5100, [1.0, None]), (5200, [float("nan")] * 6), (5300, [float("inf")] * 6), (None, [1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in vectors + bad], "vec_id long, embedding array<float>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()}
    whole = {
        i: np.floor(1024 * np.array([*map(np.float32, v), *[0.0] * (6 - len(v))], np.float64)).astype(np.int64)
        for i, v in vectors
    }
    expected = {}
    for q in whole:
        if q % 100 == 0:
            best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:10]
            expected |= {(q, rank + 1): (i, -s) for rank, (s, i) in enumerate(best)}
    assert got == expected
    assert topk.top_k(frame.limit(0), F.lit(True)).count() == 0
