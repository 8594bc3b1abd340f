import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from anchorwise.llm import common, fingerprint, packing, segment_sampling, toxicity

MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  x ", "①\n\t▁y", "é́ ﬁ", "a, b. É, c.d ,e", "<|endoftext|>X a<|startoftext|> b", "ΑΣ Σ ΣΑ", "a\x1cc d\x85", "'s it's I'LL", "İstanbul ǅ ẞ", "x" * 5000, "word, " * 4000]


# ---- sampled segmentations ----


def all_segmentations(s, vocab, lat):
    if not s:
        return [((), 0.0)]
    out = []
    for k in range(1, min(16, len(s)) + 1):
        if (i := vocab.get(s[:k])) is not None:
            out += [((i, *r), w + lat.weight[i]) for r, w in all_segmentations(s[k:], vocab, lat)]
        elif k == 1:
            raw = s[:1].encode()
            out += [((*(3 + x for x in raw), *r), w + lat.byte_weight * len(raw)) for r, w in all_segmentations(s[1:], vocab, lat)]
    return out


@pytest.mark.parametrize("text", ["the cat", "① an"])
def test_samples_follow_their_probabilities(text):
    lat, sp = segment_sampling.lattices(MODEL, 1.0), SentencePieceProcessor(model_file=MODEL)
    vocab = {sp.id_to_piece(i): i for i in range(259, 32000)}
    every = all_segmentations("▁" + text.replace(" ", "▁"), vocab, lat)
    total = np.logaddexp.reduce([w for _, w in every])
    p = {s: math.exp(w - total) for s, w in every}
    words = segment_sampling._WORD.findall("▁" + text.replace(" ", "▁"))
    n, first, second, weighed = 6000, collections.Counter(), collections.Counter(), collections.Counter()
    for rows in segment_sampling.sample_chunk(lat, [words] * n, common.mixed(np.arange(1, n + 1).astype(np.uint64)), 2):
        a, b = (tuple(segment_sampling._ids(lat, r[0]).tolist()) for r in rows)
        assert a != b and rows[0][2] >= rows[1][2] and math.isclose(math.exp(rows[0][1]), p[a], rel_tol=1e-9)
        first[a] += 1
        second[b] += 1
        for s, r in ((a, rows[0]), (b, rows[1])):
            weighed[s] += math.exp(r[1] - r[3])
    behind = {s: sum(p[o] * q / (1 - p[o]) for o in p if o != s) for s, q in p.items()}
    for s, q in p.items():
        assert abs(first[s] / n - q) < 0.03 and abs(second[s] / n - behind[s]) < 0.03 and abs(weighed[s] / n - q) < 0.03


def test_words_are_those_of_the_pattern():
    for t in [*ODD, "a b", "a", " a", "a ", "a  b", "▁", "a▁b c", "\n a\tb"]:
        assert segment_sampling.words(t) == (segment_sampling._WORD.findall("▁" + t.replace(" ", "▁")) if t else [])


def test_all_samples_of_a_small_lattice():
    lat = segment_sampling.lattices(MODEL, 1.0)
    rows = segment_sampling.sample_chunk(lat, [["▁", "①"], []], np.ones(2, np.uint64), 50)
    assert len(rows[0]) == len({tuple(r[0]) for r in rows[0]}) < 50 and abs(sum(math.exp(r[1]) for r in rows[0]) - 1) < 1e-9
    assert all(r[3] == 0.0 for r in rows[0]) and len(rows[1]) == 1 and len(rows[1][0][0]) == 0


def test_samples_decode_to_their_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (100, None), (1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("clash"))
    out = segment_sampling.sample(df, MODEL, k=3).persist()
    again = segment_sampling.sample(df.repartition(3), MODEL, k=3)
    key = lambda r: str((r.doc_id, r["rank"], r.ids, r.log_inclusion))
    assert sorted(map(key, out.collect())) == sorted(map(key, again.collect()))
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[i].add((t or "").replace("▁", " "))
    at_once = segment_sampling.sample(df, MODEL, k=3, decoded=True).drop("rank").collect()
    assert all(r.text in texts[r.doc_id] for r in at_once) and len(at_once) == out.count()
    sp = SentencePieceProcessor(model_file=MODEL)
    for r in segment_sampling.decode(out.withColumn("own", F.col("ids")), MODEL).collect():
        assert r.text in texts[r.doc_id] and sp.decode(list(r.own)) == r.text and -1e6 < r.log_inclusion <= 0
    assert segment_sampling.sample(df.limit(0), MODEL).count() == 0
    out.unpersist()


def test_weights_are_the_models_scores():
    lat, sp = segment_sampling.lattices(MODEL, 1.0), SentencePieceProcessor(model_file=MODEL)
    usable = [i for i in range(259, 32000) if not sp.is_byte(i) and not sp.is_unused(i)]
    assert all(math.isclose(lat.weight[i], -math.log(2 - sp.get_score(i))) for i in usable)
    best = max(usable, key=lambda i: lat.weight[i])
    assert sp.get_score(best) == max(map(sp.get_score, usable)) and all(lat.weight[i] < -20 for i in usable if sp.get_score(i) < -1e8)
    assert lat.longest == max(len(sp.id_to_piece(i)) for i in usable)


def test_very_long_texts(spark):
    text = "many different words " * 20 + "".join(f" w{i}" for i in range(3_000_000))  # over 20 MB
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string").repartition(1)
    r = segment_sampling.sample(df.limit(1).withColumn("text", F.substring("text", 1, 3_000_000)), MODEL, k=1, decoded=True).first()
    assert r.text == text[:3_000_000]
    got = packing.pack(df, WORDS).agg(F.sum("length"), F.max("doc_tokens")).first()
    assert got[0] > got[1] > 6_000_000
    near = {r.doc_id: r for r in fingerprint.neighbours(df).drop("edited").collect()}
    assert near[1].n_chars == len(text) and near[2].n_chars == 5
    assert {r.doc_id: r.n_words for r in toxicity.score(df, toxicity.Lexicon()).collect()}[1] > 3_000_000


# ---- packing ----


def test_ids_are_the_tokenizers_own():
    tk, enc = Tokenizer.from_file(WORDS), packing.Encoder(WORDS)
    for texts in (ODD, ODD[6:7], [x for x in ODD if "<|" not in x]):
        ids, at = enc.encode(*common.utf8(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == [*tk.encode(t, add_special_tokens=False).ids, 1]


def test_pieces_and_sequences(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (50, None)] + [(60 + i, "many words here " * (i * 37 % 900)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(2)
    got = packing.pack(df, WORDS).collect()
    tk, docs, sequences = Tokenizer.from_file(WORDS), collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in rows:
        parts = sorted(docs[i], key=lambda r: r.start)
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        assert b"".join(bytes(r.ids) for r in parts) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist() and {r.doc_tokens for r in parts} == {len(ids)}
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        total = sum(r.length for r in parts)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist() and total & (total - 1) == 0 and total <= 2048 and {r.sequence_tokens for r in parts} == {total}
    groups = collections.Counter()
    for parts in sequences.values():
        groups[parts[0].step_group] += parts[0].sequence_tokens
    assert max(groups.values()) <= packing.STEP_TOKENS
    assert packing.pack(df.limit(0), WORDS).count() == 0
    one = packing.pack(df.filter("doc_id = 12"), WORDS).select(F.crc32("ids")).first()[0]
    assert one == zlib.crc32(next(bytes(r.ids) for r in packing.pack(df.filter("doc_id = 12"), WORDS).collect()))


def test_other_tokenizers_are_refused(tmp_path):
    from tokenizers import models, pre_tokenizers

    tk = Tokenizer(models.WordLevel({"[UNK]": 0, "the": 1, "The": 2}, unk_token="[UNK]"))
    tk.pre_tokenizer = pre_tokenizers.Whitespace()
    tk.save(str(tmp_path / "t.json"))
    with pytest.raises(ValueError, match="ids depend on"):
        packing.Encoder(str(tmp_path / "t.json"))


# ---- fingerprints ----


def slow_digest(text):
    raw = text.encode()
    counts = [0] * fingerprint.BUCKETS
    for kind, (g, h) in enumerate(fingerprint.GAPS):
        for t in {raw[i] | raw[(i + g) % len(raw)] << 8 | raw[(i + h) % len(raw)] << 16 for i in range(len(raw))}:
            x = (t + 0x51ED27 * (kind + 1)) & 0xFFFFFFFF
            x = (x ^ x >> 15) * 0xC2B2AE35 & 0xFFFFFFFF
            x = (x ^ x >> 13) * 0x2545F491 & 0xFFFFFFFF
            counts[x >> 23] += 1
    o = sorted(counts)
    codes = [sum(c > o[fingerprint.BUCKETS * q // 4 - 1] for q in (1, 2, 3)) for c in counts]
    steps = min(255, round(math.log(max(len(raw), 1)) / math.log(1.1)))
    return f"{steps:02x}" + "".join(f"{codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3]:02x}" for i in range(0, len(codes), 4))


@pytest.mark.parametrize("parts", [1, 5])
def test_fingerprints_and_neighbours(spark, monkeypatch, parts):
    texts = [*ODD, *(f"text number {i} é" * i for i in range(40))]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("look", F.lit("clash")).repartition(3)
    real = fingerprint.with_next
    monkeypatch.setattr(fingerprint, "with_next", lambda d, c, i: real(d, c, i, parts))
    got = sorted(fingerprint.neighbours(df).collect(), key=lambda r: r.doc_id)
    for k, r in enumerate(got):
        a, b = texts[k], texts[(k + 1) % len(texts)]
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert (r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint) == (len(a), edited, slow_digest(a), slow_digest(edited))
        assert 0 <= r.near_next <= 1 and (r.near_edited == 1.0 if a == edited else True)


def test_long_texts_are_read_in_slices():
    text = "".join(chr(97 + i * i % 23) + str(i % 1013) for i in range(90_000))
    assert len(text) > fingerprint.SLICE
    raw, at = common.utf8(pa.array([text]))
    assert fingerprint.written(fingerprint.digests(raw, at)) == [slow_digest(text)]


def test_ranges_of_cuts(spark):
    import bisect

    ids = spark.createDataFrame([(i,) for i in range(-3, 200)] + [(None,)], "i long")
    for n in (1, 2, 3, 17, 64, 65, 150):
        cuts = [k * 190 // n for k in range(n)]
        got = {r.i: r.p for r in ids.select("i", fingerprint._range_of(F.col("i"), cuts).alias("p")).collect()}
        assert got == {None: 0, **{i: bisect.bisect_right(cuts, i) for i in range(-3, 200)}}


def test_neighbours_of_nulls_and_single_rows(spark):
    one = fingerprint.neighbours(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited == "abab" and one.near_next == 1.0
    df = spark.createDataFrame([(None, "null id"), (1, None), (1, "x"), (2, "yy")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_chars) for r in fingerprint.neighbours(df).collect()) == [("1", 0), ("1", 1), ("2", 2), ("None", 7)]
    assert fingerprint.neighbours(df.limit(0)).count() == 0


# ---- toxicity ----


def test_folding_and_exceptions():
    lex = toxicity.Lexicon(weights={" idiot": 2.0, " trash": 1.0}, exceptions=["trash can"])
    auto = lex.automaton()
    assert toxicity.fold("An 1D10T, іdіоt! tr@sh") == " an idiot idiot trash "
    total, words = lex.sums(["An 1D10T, іdіоt! tr@sh", "the trash can", "Idiotic", "xidiot", "", None], auto)
    assert total.tolist() == [5.0, 0.0, 2.0, 0.0, 0.0, 0.0] and words.tolist() == [4, 3, 1, 1, 0, 0]


def test_learned_lexicon_marks_held_out_rows(spark):
    bad, rows, labels = ["zorkumate", "zorkuling", "zorkuty"], [], []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, f"some ordinary words number {i % 17} " * 10 + (bad[i // 5 % 3] if toxic else "") + " end"))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame([*rows, (None, "you idiot"), (9000, None), (9001, "")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    lex = toxicity.fit(df, lab)
    assert any(" zorkuty".startswith(w) for w in lex.weights)
    got = {r.doc_id: r for r in toxicity.score(df, lex).withColumn("h", toxicity.held_out()).collect()}
    assert all(got[i].h == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(600))
    assert all((got[i].score >= 0.7) == bool(t) for i, t in labels if got[i].h) and got[9000].score == got[9001].score < 0.7
    assert toxicity.drop_toxic(df, lex).columns == df.columns
    assert toxicity.score(df.limit(0), lex).count() == 0


def slow_sum(text, lex):
    """Word by word, the longest entry that fits, unless the word is in a phrase."""
    words = toxicity.fold(text).split()
    inside = set()
    for p in (p.split() for p in lex.exceptions):
        inside |= {j for i in range(len(words)) if words[i : i + len(p)] == p for j in range(i, i + len(p))}
    total = 0.0
    for i, w in enumerate(words):
        fit = [e for e in lex.weights if (e.endswith(" ") and e.strip() == w) or (not e.endswith(" ") and w.startswith(e[1:]))]
        total += lex.weights[max(fit, key=len)] if fit and i not in inside else 0.0
    return total


def test_sums_against_a_slow_matcher():
    rng = random.Random(4)
    lex = toxicity.Lexicon(weights={" idiot ": 3.0, " idio": 1.5, " trash ": 2.0, " cl": 0.5, " clow": 4.0, " clown ": 3.0, " x ": 1.0}, exceptions=["trash can", "clown car", "class clown", "clown"[:3] + "ck trash can x"])
    words = ["idiot", "idiots", "trash", "trashed", "can", "clown", "clowns", "car", "class", "clock", "x", "xx", "tr@sh", "fine"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(400)] + ["class clown car", "a clown", "trash", None, "", "clock trash can x trash can"]
    total, _ = lex.sums(texts, lex.automaton())
    assert total.tolist() == [slow_sum(t, lex) for t in texts]


def test_insults_are_whole_words_and_count_once():
    lex = toxicity.Lexicon()
    assert lex.sums(["trashed", "scumble", "losers", "a clown"], lex.automaton())[0].tolist() == [0.0, 0.0, 0.0, 3.0]


def test_the_length_of_a_text_alone_has_no_part():
    lex = toxicity.Lexicon()
    text = "you idiot " + "word " * 98
    total, words = lex.sums([text, text * 50], lex.automaton())
    a, b = lex.scores(total, words)
    assert a < b < a + 0.2  # but for the 50 words that are added to each


def test_scores_pass_clashing_columns(spark):
    df = spark.createDataFrame([(1, "idiot moron", 5.0, "m")], "doc_id long, text string, __score double, __Matched string")
    got = toxicity.drop_toxic(df, toxicity.Lexicon(), limit=1.0)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [tuple(r) for r in df.collect()]


def test_fit_without_labels_and_bounded_sample(spark):
    df = spark.createDataFrame([(1, "idiot"), (2, "fine")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(df, none).weights == toxicity.Lexicon().weights
    rows = [(i, f"zorkumate number{i}" if i % 3 else "plain text") for i in range(300)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, toxic int")
    assert any(w.startswith(" zork") for w in toxicity.fit(docs, labels).weights)
    assert not any(w.startswith(" zork") for w in toxicity.fit(docs, labels, sample=2).weights)  # too few to tell
