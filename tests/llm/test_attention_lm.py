"""The attention language model: gradients, windows, normalisation, and scores against a
plain version."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopflow.llm import attention_lm as lm, attention_net as net
from shopflow.llm.queries import subwords
from tests.llm.cases import DOCS, clashing, corpus, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def path():
    return subwords()


def small_net(seed=0, classes=7, width=5, stride=4, kind=np.float64):
    rng = np.random.default_rng(seed)
    made = net.start(rng.integers(0, 50, (classes, classes)).astype(float), width, stride)
    return {k: (v + rng.standard_normal(v.shape) * 0.3).astype(kind) for k, v in made.items()}


def test_gradient(monkeypatch):
    monkeypatch.setattr(net, "F32", np.float64)
    rng, p = np.random.default_rng(1), small_net()
    lengths = np.array([3, 9, 17, 1])
    found = net.Windows(np.cumsum(lengths) - lengths, lengths, 4).at(slice(None))
    ids = rng.integers(0, 7, lengths.sum() + 1)
    batch = ids[found.places], found.first, ids[found.places[:, 4:] + 1], found.real
    gradient = net.Net(p, 4).gradient(*batch)[1]
    for name in net.NAMES:
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            old, losses = p[name][at], []
            for shift in (1e-6, -1e-6):
                p[name][at] = old + shift
                losses.append(net.Net(p, 4).gradient(*batch)[0])
            p[name][at] = old
            assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(gradient[name][at], abs=1e-6)


def test_windows_predict_every_position_once():
    lengths = np.array([1, 4, 5, 8, 100])
    begins = np.cumsum(lengths) - lengths
    every = net.Windows(begins, lengths, 4)
    found, text, number = every.at(slice(None)), every.text, every.number
    assert sorted(found.places[:, 4:][found.real]) == list(range(lengths.sum()))
    for places, first, t, k in zip(found.places, found.first, text, number):
        assert first == (k == 0) and places.min() >= begins[t] and places.max() < begins[t] + lengths[t]
        if not first:
            assert list(places[:4]) == list(range(begins[t] + 4 * (k - 1), begins[t] + 4 * k))


def test_cut_windows_hold_the_tokens_at_their_places():
    lengths = np.array([1, 4, 5, 8, 100, 1])
    begins = np.cumsum(lengths) - lengths
    ids = np.random.default_rng(4).integers(0, 250, lengths.sum() + 1).astype(np.uint8)
    every = net.Windows(begins, lengths, 4)
    chosen = np.arange(len(every))[::-1]
    found, cut = every.at(chosen), every.cut(every.pieces(ids), chosen)
    assert (cut.first == found.first).all() and (cut.real == found.real).all()
    assert (cut.target[cut.real] == ids[found.places[:, 4:] + 1][cut.real]).all()
    assert (cut.x[:, 4:][cut.real] == ids[found.places[:, 4:]][cut.real]).all()
    assert (cut.x[:, :4][~cut.first] == ids[found.places[:, :4]][~cut.first]).all()


@pytest.mark.parametrize("base2", [True, False])
@pytest.mark.parametrize("windows", [1, 3, net._ROWS // 16, 2 * net._ROWS // 16, 2 * net._ROWS // 16 + 1])
def test_grouped_windows_equal_windows_alone(monkeypatch, windows, base2):
    """However positions are grouped, and whichever power is in use."""
    monkeypatch.setattr(net, "_power", np.exp2 if base2 else np.exp)
    monkeypatch.setattr(net, "_LOG_BASE", math.log(2) if base2 else 1.0)
    rng, p = np.random.default_rng(5), small_net(6, 9, 6, 16, np.float32)
    x, target = rng.integers(0, 9, (windows, 32)), rng.integers(0, 9, (windows, 16))
    first, real = rng.random(windows) < 0.3, rng.random((windows, 16)) < 0.8
    real[:, 0] = True
    network = net.Net(p, 16)
    loss, gradient = network.gradient(x, first, target, real)
    logs = network.log_probabilities(x, first, target)
    assert loss == pytest.approx(-logs[real].mean(), rel=1e-4)
    each = [net.Net(p, 16).gradient(*(part[i : i + 1] for part in (x, first, target, real))) for i in range(windows)]
    share = real.sum(1) / real.sum()
    assert loss == pytest.approx(sum(w * one for w, (one, _) in zip(share, each)), rel=1e-4)
    for name in net.NAMES:
        want = sum(w * g[name] for w, (_, g) in zip(share, each))
        assert gradient[name] == pytest.approx(want, abs=2e-5)


def one_by_one(p, stride, classes):
    """log10 distributions of the next class behind every prefix, one position at a time."""
    d, out = p["embed"].shape[1], []
    for t in range(len(classes)):
        seen = range(max(0, (t // stride - 1) * stride), t + 1)
        h = [p["embed"][classes[j]] for j in seen]
        q = h[-1] @ p["query"]
        w = [math.exp(q @ (x @ p["key"]) / math.sqrt(d) + p["distance"][t - j]) for j, x in zip(seen, h)]
        read = sum(a * (x @ p["value"]) for a, x in zip(w, h)) / sum(w)
        y = (h[-1] + read) @ p["out"] + p["bias"]
        out.append((y - math.log(np.exp(y).sum())) / math.log(10))
    return out


def test_windows_equal_positions_one_by_one():
    p = small_net(2, kind=np.float32)
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 5, 30])
    begins = np.cumsum(lengths) - lengths
    ids = rng.integers(0, 7, lengths.sum() + 1)
    found = net.Windows(begins, lengths, 4).at(slice(None))
    logs = net.Net(p, 4).log_probabilities(ids[found.places], found.first, ids[found.places[:, 4:] + 1])
    made = np.empty(lengths.sum())
    made[found.places[:, 4:][found.real]] = logs[found.real] / math.log(10)
    for b, n in zip(begins, lengths):
        want = [row[ids[b + i + 1]] for i, row in enumerate(one_by_one(p, 4, ids[b : b + n]))]
        assert made[b : b + n] == pytest.approx(want, abs=1e-4)


@pytest.fixture(scope="module")
def rows():
    odd = ["THE End.", "<|endoftext|> a<|endoftext|>b", "\xa0x 　 y\x85", "a\x0bb\x1cc", "😀 漢字", "x" * 3000]
    return corpus() + [(500 + i, t, "en", "a", 1) for i, t in enumerate(odd * 8)] + [(None, "no id", None, None, 1), (None, None, None, None, 0)]


@pytest.fixture(scope="module")
def learned(spark, rows, path):
    return lm.fit(lm.encode(frame(spark, rows), path).where(~F.col("held_out")), path)


def words_of(text):
    return (text or "").encode().lower().split()


def test_equals_plain_version(spark, rows, path, monkeypatch):
    monkeypatch.setattr(lm, "HOT_WORDS", 40)  # most words then go through the join
    encoded = lm.encode(frame(spark, rows), path)
    model = lm.fit(encoded.where(~F.col("held_out")), path)
    found = sorted((tuple(r) for r in lm.score(encoded, model).collect()), key=repr)
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, *_ in rows}
    counts, ends = Counter(), 0
    for i, text, *_ in rows:
        if not held[i]:
            counts.update(words_of(text))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    assert (model.train_tokens, model.distinct) == (total, distinct)

    spell, begin = lm.vocabulary(path).spell, lm.vocabulary(path).begins
    params = net.unflat(model.values, lm.CLASSES, lm.WIDTH, lm.STRIDE)
    want = []
    for i, text, *_ in rows:
        words = words_of(text)
        ids = np.frombuffer(b"".join(spell([w])[0] for w in words), "<u2")
        known, next_ = np.append(lm.END, ids), np.append(ids, lm.END)
        logs = [row[model.class_of[n]] for row, n in zip(one_by_one(params, lm.STRIDE, model.class_of[known]), next_)]
        share = model.share[model.class_of[known], np.minimum(next_, model.share.shape[1] - 1)]
        logs = np.add.reduceat(np.array(logs) + share, np.flatnonzero(begin[next_]))
        assert len(logs) == len(words) + 1
        seen = [counts[w] for w in words] + [ends]
        base = sum(math.log10((c + 0.5) / (total + 0.5 * (distinct + 1))) for c in seen)
        score = sum(
            math.log10(lm.MIX * c / total + (1 - lm.MIX) * 10.0**x) if c else math.log10(1 - lm.MIX) + x
            for c, x in zip(seen, logs)
        )
        want.append((i, held[i], len(seen), sum(c > 0 for c in seen), total, base, score))
    want.sort(key=repr)
    for a, b in zip(found, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-4, abs=1e-3)


def test_words_spell_alone_as_together(path):
    known = lm.vocabulary(path)
    words = sorted({w for t in ["it's a a1b2... <|endoftext|> é漢字 \x1c\x1dx \x00 ''", "x" * 5000] for w in words_of(t)})
    for extra in ([], ["\xa0".encode()], ["\xa0a".encode(), "b\x85".encode(), "\u3000".encode()]):
        made = known.spell(words + extra)
        assert made == [known.spell([w])[0] for w in words + extra] and len(set(made)) == len(made)
        assert all(known.begins[i] == (k == 0) for m in made for k, i in enumerate(np.frombuffer(m, "<u2")))
    assert known.spell([]) == []


def test_known_words_are_spelled_once(path, monkeypatch):
    """A slice's new words alone reach the tokenizer, and what is known is bounded."""
    known, texts = lm._Vocabulary(path), [["b A a", None, " c\na "], ["a d", "", "d b é漢字"], ["x" * 900 + " a"]]
    met, encode = [], known.encode
    known.encode = lambda text: met.append(text) or encode(text)
    made = [known.encode_texts(pa.array(part, pa.string())) for part in texts]
    assert met == [" b a c", " d é漢字", " " + "x" * 900]
    monkeypatch.setattr(lm, "KNOWN_WORDS", 2)
    again = [known.encode_texts(pa.array(part, pa.string())) for part in texts]
    assert len(known.known) <= 2
    for part, (counts, packed), (_, same) in zip(texts, made, again):
        assert packed.equals(same) and counts.tolist() == [len(words_of(t)) for t in part]
        assert packed.to_pylist() == [b"".join(lm.vocabulary(path).spell([w])[0] for w in words_of(t)) for t in part]


def test_distribution_sums_to_one(learned):
    size = learned.share.shape[1] - 1
    of = lm.classes_with_end(learned.class_of, size)
    for row in 10.0 ** learned.share[::17].astype(float):
        assert np.bincount(of, row, lm.CLASSES)[np.unique(of)] == pytest.approx(1, rel=1e-3)
    for row in one_by_one(net.unflat(learned.values, lm.CLASSES, lm.WIDTH, lm.STRIDE), lm.STRIDE, of[:40]):
        assert (10.0 ** row[np.unique(of)]).sum() == pytest.approx(1, rel=1e-4)


def test_learns_from_every_position(spark, rows, path, learned):
    """Gradient steps take all windows of all training documents, each once."""
    training = [t for i, t, *_ in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    ids = sum(len(b"".join(lm.vocabulary(path).spell([w])[0] for w in words_of(t))) // 2 for t in training)
    assert learned.learned == ids + len(training)


def test_later_words_change_nothing_before(learned, path):
    network, small = net.Net(net.unflat(learned.values, lm.CLASSES, lm.WIDTH, lm.STRIDE), lm.STRIDE), learned.class_of.astype(np.uint8)

    def logs(text):
        ids = b"".join(lm.vocabulary(path).spell(words_of(text)))
        return lm.id_scores(pa.RecordBatch.from_pydict({"ids": [ids]}), learned, network, small)[1]

    start = "w1 w2 w3 w4 w5 " * 9
    a, b = logs(start + "w1 w2 w3"), logs(start + "x9 y8 z7 z6")
    same = len(logs(start)) - 1
    assert a[:same] == pytest.approx(b[:same], abs=1e-5) and abs(a[same + 1] - b[same + 1]) > 1e-3


def test_learns_from_the_corpus(spark, path):
    """On held-out texts the model beats the share of each id by far, and its own start."""
    encoded = lm.encode(spark.read.parquet(f"{SF}/documents.parquet"), path)
    training = encoded.where(~F.col("held_out"))
    model = lm.fit(training, path)
    batch = encoded.where("held_out").select("ids").toArrow().combine_chunks().to_batches()[0]
    small = model.class_of.astype(np.uint8)

    def mean(values):
        return lm.id_scores(batch, model, net.Net(net.unflat(values, lm.CLASSES, lm.WIDTH, lm.STRIDE), lm.STRIDE), small)[1].mean()

    counts = lm.id_counts(model.words) + 0.5
    counts[lm.END] = model.hot_counts[0]
    plain = np.log10(counts / counts.sum())[lm._Texts(batch).predicted].mean()
    size = lm.vocabulary(path).size
    behind = lm.neighbours(training, model.class_of, lm.CLASSES, size, before=False)[0]
    pairs = np.stack([np.bincount(lm.classes_with_end(model.class_of, size), row, lm.CLASSES) for row in behind])
    first = mean(net.flat(net.start(pairs, lm.WIDTH, lm.STRIDE)))
    assert mean(model.values) > plain + 0.3 and mean(model.values) > first


def test_repeats(spark, rows, path):
    both = [
        sorted((tuple(r) for r in lm.scores(frame(spark, rows), path).collect()), key=repr) for _ in range(2)
    ]
    assert both[0] == both[1]


def test_edge_tables(spark, path):
    assert lm.scores(frame(spark, [], DOCS), path).collect() == []
    gone = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1]
    only = [(i, "never seen", "en", "a", 1) for i in gone] + [(gone[0], "", None, None, 0)]
    for r in lm.scores(frame(spark, only), path).collect():
        assert r.held_out and r.n_known == r.train_tokens == 0 and r.base_score == 0 and r.score < 0
    blank = [(i, t, None, None, 0) for i, t in enumerate([None, "", " \n"] * 4)]
    assert {(r.n_tokens, r.n_known) for r in lm.scores(frame(spark, blank), path).collect()} == {(1, 1)}


def test_other_columns(spark, path):
    rows = corpus(4, 3)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    a, b = (
        sorted((tuple(r) for r in lm.scores(t, path).select(*names).collect()), key=repr)
        for t in (frame(spark, rows), clashing(spark, rows).selectExpr("*", "1 AS uid", "2 AS held_out", "3 AS ids", "4 AS n"))
    )
    assert a == b
