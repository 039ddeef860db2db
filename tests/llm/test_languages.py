"""Language identification: the network against a plain version, held-out accuracy, labels, bounds."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from tramline.llm import languages  # noqa: E402
from tramline.llm.queries import op13_language_id  # noqa: E402

SYLLABLES = {"aa": ["ka", "to", "ri", "ne"], "bb": ["sch", "ung", "eit", "lö"], "cc": ["що", "ми", "ра", "на"]}


def _text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def _rows(count, seed=5):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        lang = rng.choice(list(SYLLABLES))
        text = _text(rng, lang, rng.choice([3, 20, 200]))
        rows.append((n, text, lang, "s", len(text)))
    return rows


def test_windows_cover_every_run_of_bytes():
    for length in (0, 1, 255, 256, 257, 508, 509, 510, 5000):
        text = bytes(random.Random(length).randrange(1, 256) for _ in range(length))
        windows = languages.windows_of(text)
        widest = max(languages.WIDTHS)
        runs = {text[i : i + widest] for i in range(length - widest + 1)}
        assert runs <= {bytes(w[i : i + widest]) for w in windows for i in range(languages.WINDOW - widest + 1)}
        assert sum(windows[-1] != 0) == length - (len(windows) - 1) * languages.STEP


def test_scores_equal_plain_convolution():
    rng = np.random.default_rng(3)
    network = languages.ByteNetwork.new(3, rng)
    network.offsets[:] = rng.normal(0, 0.3, len(network.offsets))
    window = rng.integers(0, 256, languages.WINDOW).astype(np.uint8)
    pooled = []
    for n, width in enumerate(languages.WIDTHS):
        for f in range(languages.FILTERS):
            weights = network.filters[: width * languages.BYTE_SIZE, n * languages.FILTERS + f]
            best = max(
                float(np.concatenate([network.byte_vectors[b] for b in window[i : i + width]]) @ weights)
                for i in range(languages.STEP)
            )
            pooled.append(max(0.0, best + network.offsets[n * languages.FILTERS + f]))
    plain = np.array(pooled) @ network.softmax + network.bias
    plain -= np.log(np.exp(plain).sum())
    assert np.allclose(network.scores(window[None])[0], plain, atol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(4)
    network = languages.ByteNetwork.new(3, rng)
    for name in ("byte_vectors", "filters", "offsets", "softmax", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    windows, classes = rng.integers(1, 256, (5, languages.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    loss = lambda: -network.scores(windows)[np.arange(5), classes].mean()
    for parameter, gradient in zip(network.parameters(), network.gradients(windows, classes)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, parameter[at] = parameter[at], parameter[at] + 1e-6
        above = loss()
        parameter[at] = before - 1e-6
        below = loss()
        parameter[at] = before
        assert abs((above - below) / 2e-6 - gradient[at]) < 1e-4


def test_held_out_accuracy_and_labels_unseen(spark, tmp_path):
    rows = _rows(600)
    folder = corpus.write_tables(spark, tmp_path / "a", rows)
    first = {r["doc_id"]: r for r in op13_language_id(spark, folder).collect()}
    held = [r for r in rows if first[r[0]]["held_out"]]
    assert 100 < len(held) < 300
    assert sum(first[r[0]]["lang_pred"] == r[2] for r in held) >= 0.97 * len(held)
    # Labels of held-out rows, sources and n_chars change nothing.
    changed = [(r[0], r[1], "zz" if first[r[0]]["held_out"] else r[2], "other", 0) for r in rows]
    again = {r["doc_id"]: r for r in op13_language_id(spark, corpus.write_tables(spark, tmp_path / "b", changed)).collect()}
    assert first == again


def test_undetermined_and_few_labels(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "12 34 !?", "en", "s", 0), (4, "é", "fr", None, None), (None, "abc", "xx", None, 3)]
    got = {r["doc_id"]: r for r in op13_language_id(spark, corpus.write_tables(spark, tmp_path / "one", rows)).collect()}
    assert [got[n]["lang_pred"] for n in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    learned = {"fr"} if not got[4]["held_out"] else {"und"}
    assert got[4]["lang_pred"] in learned and got[None]["lang_pred"] in learned and not got[None]["held_out"]
    unlabelled = [(n, "some text", None, "s", 9) for n in range(5)]
    none = op13_language_id(spark, corpus.write_tables(spark, tmp_path / "none", unlabelled)).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_training_rows_are_bounded_under_one_id(spark, monkeypatch):
    seen = {}
    real = languages.train
    monkeypatch.setattr(languages, "train", lambda w, c, n: seen.update(windows=len(w)) or real(w, c, n, epochs=1))
    rng = random.Random(1)
    hot = next(n for n in range(9) if zlib.crc32(str(n).encode()) % 3 != 1)
    rows = [(hot, _text(rng, lang, 5), lang, "s", 0) for lang, count in (("aa", 300), ("bb", 30)) for _ in range(count)]
    frame = spark.createDataFrame(rows, corpus.DOCUMENTS)
    languages.fit(frame, rows=100, rows_of_language=40)
    assert seen["windows"] <= 70
