"""Token counts, SentencePiece, chat, rules, classifier: parity, round trips, held-out accuracy."""
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_CHECK, SF_SMOKE
from tokenizers import Tokenizer

from eddy.llm import chat_format, nb_svm, piece_codec, quality_rules, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", " ", "  ", "   a", "▁", "▁▁", "a  ", "\n", "x" * 3000, " " * 3000, "ΣΑΣ ΣΑΣ.", "<|endoftext|><|startoftext|> x", "<s>", "</s>",
       "e\u0301 \u0130 \u1e9e 中文 각 😀\u200d😀", "\x1c\x85\u2028\u00a0", "a\u0558b\U0002b73a", "'LL 'll don't I'VE", "aaab" * 300, "12345 6,7"]


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(3)
    letters = [chr(x) for x in range(1, 300)] + ["▁", "  ", "中", "😀", "the ", "<|endoftext|>", "<s>", "<0x41>", "\u0301"]
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(500)]


def table(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a b", "x", 1), (7, None, "x", 1), (7, None, "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_bytes int"), rows


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_equal_the_library(spark, strings, name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    df, rows = table(spark, strings)
    got = sorted(map(tuple, token_counts.count_tokens(df, path, limit=20).collect()), key=str)
    want = []
    for d, t, *_ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 20))
    assert got == sorted(want, key=str)


def test_token_counts_of_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_merging_one_place_at_a_time_when_ranks_are_out_of_order():
    vocab = {c: i for i, c in enumerate(["a", "b", "ab", "aba", "c"])}
    merger = token_counts.Merger({"vocab": vocab, "merges": [["ab", "a"], ["a", "b"]]})
    assert not merger.ordered
    # a merge of a, b makes the pair ab, a, which goes first
    assert merger.counts([b"abab", b"", b"a", b"abc"]).tolist() == [2, 0, 1, 2]


def test_sentencepiece_equals_the_library(spark, strings):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    df, rows = table(spark, strings)
    texts = [t or "" for _, t, *_ in rows]
    encoded = piece_codec.encode(df, path)
    want = sorted(((d, library.encode(t)) for (d, *_), t in zip(rows, texts)), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in encoded.collect()), key=str) == want
    assert encoded.where("not parity").count() == 0
    back = sorted(((r.doc_id, r.text) for r in piece_codec.decode(encoded, path).collect()), key=str)
    assert back == sorted(((d, library.decode(i)) for d, i in want), key=str)
    whole = piece_codec.encode_and_check(df, path).collect()
    assert sorted(((r.doc_id, list(r.ids)) for r in whole), key=str) == want
    assert all(r.round_trip for r, in zip(whole) if r.doc_id is not None and "▁" not in (texts[r.doc_id] if r.doc_id < len(strings) else ""))
    assert piece_codec.encode_and_check(df.limit(0), path).count() == 0


def test_unigram_model_is_rebuilt():
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    # the same pieces read as a unigram model, with extra spaces taken out
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.remove_extra_whitespaces = True
    for i, p in enumerate(proto.pieces):
        if p.type == 1:
            p.score = -3.0 - (i % 97) / 7.0
    model = proto.SerializeToString()
    codec, library = piece_codec.Codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["the  quick brown fox", "  jumped over ", "naïve 中 text", "", "a"]
    ids, off, _ = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == library.encode(texts)


def test_chat_round_trip():
    rng = random.Random(1)
    bits = [*chat_format.CONTROLS, chat_format.SIGN, chat_format.SIGN * 2, "<", "[", "s>", "INST]", "a", "\n", ">", "</s", "[/INST"]
    turns = [tuple("".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(2)) for _ in range(3000)]
    turns += [("assistant", t) for _, t in turns[:500]]
    assert chat_format.parse("".join(chat_format.format_turn(*t)[0] for t in turns)) == turns
    for role, text in turns:
        formatted, a, b = chat_format.format_turn(role, text)
        assert chat_format.unescape(formatted[a:b]) == (text if role == "assistant" else "")
    assert chat_format.format_turn("user", "plain")[0] == "<s>[INST]user[/INST]plain</s>"
    for bad in ("x", "<s>[INST]user</s>", "<s>[INST]user[/INST]text", "<s>[INST]a[/INST]b</s></s>"):
        with pytest.raises(chat_format.ParseError):
            chat_format.parse(bad)


def test_chat_digests_match_sql(spark, scratch):
    import duckdb
    rng = random.Random(2)
    rows = [(rng.choice([*range(20), None]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", None, "</s>"]),
             rng.choice([None, "", "x", "ü␛", "</s>[INST]", "long " * 2000]), "clash") for _ in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    df.write.parquet(f"{scratch}/t")
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from read_parquet('{scratch}/t/*.parquet')")
    extra = "select 1, 1, '', '' where false"
    want = sorted(db.sql(chat_format.read_back_sql(extra)).fetchall(), key=str)
    got = chat_format.read_back(chat_format.format_conversations(df))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0


def plain_counts(t):
    words = WORD.findall(t or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered, lines, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(covered)


def test_models_that_the_codec_does_not_rebuild_raise():
    from sentencepiece import sentencepiece_model_pb2
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.trainer_spec.treat_whitespace_as_suffix = True
    with pytest.raises(ValueError, match="behind words"):
        piece_codec.Codec(proto.SerializeToString())


def test_rule_counts_match_plain_python(spark, strings):
    texts = strings + ["a\nb\na\n\n\na ", "x y z " * 20, "HELLO WORLD " * 5, None, "é" * 10 + "#"]
    df, rows = table(spark, texts)
    got = quality_rules.judge(df).collect()
    have = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str)
    assert have == sorted(((d, *plain_counts(t)) for d, t, *_ in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_rules_keep_clean_documents(spark):
    got = quality_rules.judge(spark.read.parquet(f"{SF_CHECK}/documents.parquet")).toPandas()
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").toPandas()
    both = got[~got.base_failed].merge(labels, on="doc_id")
    assert (both.kept == (both.quality == 1)).mean() > 0.97


def test_kept_is_no_single_rule_nor_all_of_them(spark):
    got = quality_rules.judge(spark.read.parquet(f"{SF_CHECK}/documents.parquet")).toPandas()
    names = list(quality_rules.rules())
    passed = ~got.base_failed
    for name in names:
        for says in (got[name] > 0, got[name] >= 0):
            assert (got.kept != (passed & says)).any(), name
    assert (got.kept != (passed & (got[names] >= 0).all(axis=1))).any()
    assert (got.kept != (passed & (got[names].sum(axis=1) > 0))).any()       # nor a majority
    assert list(got.columns[:8]) == ["doc_id", *quality_rules.BASE, "base_failed", "kept"]


def test_posteriors_equal_expectation_maximisation_document_by_document(spark):
    """The model on documents, in plain Python and without patterns, gives the same posteriors."""
    got = quality_rules.judge(spark.read.parquet(f"{SF_SMOKE}/documents.parquet")).collect()
    names = list(quality_rules.rules())
    votes = [[r[n] for n in names] for r in got]
    prior = {k: [x * len(votes) / 1000 for x in quality_rules.PRIOR[k]] for k in ("bad", "good")}
    p = [0.1 if min(v) < 0 else 0.9 for v in votes]
    for _ in range(quality_rules.ROUNDS):
        chance = {}
        for kind, weight in (("bad", [1 - x for x in p]), ("good", p)):
            for r in range(len(names)):
                counts = list(prior[kind])
                for v, w in zip(votes, weight):
                    counts[v[r] + 1] += w
                chance[kind, r] = [c / sum(counts) for c in counts]
        share = min(max(sum(p) / len(p), 1e-6), 1 - 1e-6)
        before, p = p, []
        for v in votes:
            good, bad = share, 1 - share
            for r, x in enumerate(v):
                good *= chance["good", r][x + 1]
                bad *= chance["bad", r][x + 1]
            p.append(good / (good + bad))
        if max(abs(x - y) for x, y in zip(p, before)) < 1e-10:
            break
    assert max(abs(x - r.posterior) for x, r in zip(p, got)) < 1e-8


def test_expectation_maximisation_finds_planted_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.7
    right = np.array([0.9, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((20000, 4)) < 0.5, 0, np.where((rng.random((20000, 4)) < right) == good[:, None], 1, -1))
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    chances, share = quality_rules.fit_votes(patterns, n.astype(float), rounds=2000)
    assert abs(share - 0.7) < 0.05
    assert np.abs(chances[1, :, 2] / (chances[1, :, 0] + chances[1, :, 2]) - right).max() < 0.06


def test_classifier_learns_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = nb_svm.classify(docs, nb_svm.train(docs, labels)).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    both = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.93
    assert (got.predicted == (got.score >= 0.3)).all()


def test_counts_add_up_a_few_tasks_at_a_time(spark, monkeypatch, scratch):
    """40 tasks, three at a time: no group gets more, and the sums are the same."""
    rng = np.random.default_rng(1)
    blobs = rng.integers(0, 1 << 40, (40, 2, nb_svm.BLOCK))
    rows = [(k, label, part, blobs[part, label].tobytes()) for k in (3, 9) for part in range(40) for label in (0, 1)]
    counts = spark.createDataFrame([(k, x, p, bytearray(b)) for k, x, p, b in rows], "block int, label int, part int, data binary").repartition(8)
    real = nb_svm._total
    seen = spark.sparkContext.accumulator(0)

    def watched(table):
        assert table.num_rows <= 3
        seen.add(1)
        return real(table)
    monkeypatch.setattr(nb_svm, "FAN_IN", 3)
    monkeypatch.setattr(nb_svm, "_total", watched)
    got = {(r["block"], r["label"]): np.frombuffer(r["data"], np.int64) for r in nb_svm._totals(counts).collect()}
    assert set(got) == {(k, x) for k in (3, 9) for x in (0, 1)}
    assert all((v == blobs[:, x].sum(axis=0)).all() for (_, x), v in got.items())
    assert seen.value >= 4 * (14 + 5 + 2 + 1)


def test_classifier_never_sees_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMOKE}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.withColumn("quality", (1 - labels.quality * nb_svm.held_out(labels.doc_id).cast("int")).cast("int"))
    changed = changed.where(nb_svm.held_out("doc_id") if False else nb_svm.held_out(labels.doc_id)).unionByName(labels.where(~nb_svm.held_out(labels.doc_id)))
    a, b = (nb_svm.classify(docs, nb_svm.train(docs, x)).toPandas().sort_values("doc_id") for x in (labels, changed))
    assert np.array_equal(a.score.to_numpy(), b.score.to_numpy())


def test_classifier_without_labels_and_odd_rows(spark):
    df, _ = table(spark, ["x" * 100, "", "a b c"])
    for labels in ([], [(1, 1)], [(1, None), (2, 0), (2, 1), (None, 1), (0, 7)], [(1, 1), (0, 0), (0, 0)]):
        model = nb_svm.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = nb_svm.classify(df, model).collect()
        assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
        assert nb_svm.keep_good(df, model).columns == df.columns
    assert nb_svm.classify(df.limit(0), model).count() == 0


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 5)) if i % 2 else np.unique(rng.integers(50, 100, 5)) for i in range(200)]
    labels = np.arange(200) % 2
    w, bias = nb_svm.dual_descent(rows, labels, np.ones(100), np.ones(200))
    assert all((w[r].sum() / np.sqrt(len(r)) + bias > 0) == (y == 1) for r, y in zip(rows, labels))
