from __future__ import annotations

import struct

import numpy as np

from colonnade.llm import audio


def tune(notes, rate=audio.RATE, length=audio.HOP):
    time = np.arange(int(length * rate / audio.RATE)) / rate
    return np.concatenate([6000 * np.sin(2 * np.pi * 220 * 2 ** (n / 12) * time) for n in notes])


def test_same_tune_elsewhere_aligns():
    rng = np.random.default_rng(0)
    notes = rng.integers(0, 12, 80)
    whole = audio.fingerprint_wav(audio.write_wav(tune(notes)))
    later = audio.fingerprint_wav(audio.write_wav(np.concatenate([np.zeros(5 * audio.HOP), tune(notes)]) + rng.standard_normal(85 * audio.HOP) * 30))
    other = audio.fingerprint_wav(audio.write_wav(tune(rng.integers(0, 12, 80))))
    found = list(audio.alignments(whole, audio.Index([later, other, whole])))
    assert [(w, o) for w, o, *_ in found] == [(0, 5), (2, 0)] and found[1][3] == 0.0 and found[0][3] < 0.1
    assert audio.bit_errors(whole, other, 0)[0] > 0.25


def test_rates_channels_and_kinds():
    notes = np.random.default_rng(1).integers(0, 12, 40)
    low = audio.fingerprint_wav(audio.write_wav(tune(notes)))
    high = tune(notes, 16000)
    stereo = np.repeat(high, 2).astype("<i2").tobytes()
    wav = b"RIFF" + struct.pack("<I", 0) + b"WAVEJUNK" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 16000, 64000, 4, 16) + b"data" + struct.pack("<I", len(stereo)) + stereo
    n = min(len(low), len(got := audio.fingerprint_wav(wav)))
    assert n > 20 and audio.bit_errors(low[:n], got[:n], 0)[0] < 0.15
    for bad in (None, b"", b"RIFFxxxxWAVE", b"not audio", audio.write_wav(np.zeros(100))):
        assert len(audio.fingerprint_wav(bad)) == 0


def test_integral_image_against_sums():
    image = np.random.default_rng(2).random((30, 12))
    got = audio.fingerprint(image)
    for at in (0, 7, len(got) - 1):
        bits = 0
        for kind, first, tall, wide in audio.FILTERS:
            part, all_of_it = image[at : at + wide, first : first + tall], image[at : at + wide]
            cut, half = tall // 2, (wide + 1) // 2
            a, b = [
                lambda: (part.sum(), all_of_it.sum() - part.sum()),
                lambda: (part[:, cut:].sum(), part[:, :cut].sum()),
                lambda: (part[half:].sum(), part[:half].sum()),
                lambda: (part[:half, :cut].sum() + part[half:, cut:].sum(), part[:half, cut:].sum() + part[half:, :cut].sum()),
            ][kind]()
            step = sum(np.log((a + 0.01) / (b + 0.01)) >= x for x in audio.BOUNDS)
            bits = bits << 2 | (0, 1, 3, 2)[step]
        assert int(got[at]) == bits


def all_offsets(query, other):
    """The best alignment within the bounds by trying every offset, or None."""
    told = [(audio.better(*audio.bit_errors(query, other, o), o), o, *audio.bit_errors(query, other, o)) for o in range(-len(query), len(other) + 1)]
    fine = [x for x in told if x[2] <= audio.ERRORS and x[3] >= audio.OVERLAP]
    return min(fine)[1:] if fine else None


def test_recall_of_shifted_noisy_copies():
    """Copies shifted by any part of a hop, with 20 dB of noise: nine in ten of those that some offset aligns within the bounds are found, at that offset."""
    rng = np.random.default_rng(8)
    within = found = same = 0
    for k in range(120):
        clean = tune(rng.integers(0, 24, 64))
        later = np.concatenate([np.zeros(rng.integers(0, 3 * audio.HOP)), clean])
        later = later + rng.normal(0, 1, len(later)) * np.sqrt((clean**2).mean()) / 10
        a, b = (audio.fingerprint_wav(audio.write_wav(x)) for x in (clean, later))
        best, got = all_offsets(a, b), list(audio.alignments(a, audio.Index([b])))
        within += best is not None
        found += best is not None and len(got) == 1
        same += best is not None and [x[1] for x in got] == [best[0]]
        assert best is not None or not got
    assert within > 100 and found >= 0.9 * within and same >= 0.9 * within


def test_chance_likenesses_are_found_too():
    """Many short tunes of few notes, some of which are alike somewhere by chance."""
    rng = np.random.default_rng(5)
    prints = [audio.fingerprint_wav(audio.write_wav(tune(np.repeat(rng.integers(0, 3, 16), 3)))) for _ in range(150)]
    index, within, found = audio.Index(prints), 0, 0
    for q in prints[:12]:
        got = {w: (o, s, n) for w, o, _, s, n in audio.alignments(q, index)}
        expected = {w: x for w, p in enumerate(prints) if (x := all_offsets(q, p))}
        assert got.keys() <= expected.keys()
        within += len(expected)
        found += sum(got.get(w) == x for w, x in expected.items())
    assert within > 12 and found >= 0.9 * within


def test_query_against_brute_force(spark):
    rng = np.random.default_rng(3)
    notes = [rng.integers(0, 12, 50) for _ in range(12)]
    sounds = [tune(n) for n in notes] + [np.concatenate([np.zeros(3 * audio.HOP), tune(notes[k])]) for k in (0, 5)] + [tune(notes[0])] * 3
    rows = [(i * 10, bytearray(audio.write_wav(s)), "x") for i, s in enumerate(sounds)] + [(500, None, "y"), (510, bytearray(b"?"), "y"), (None, bytearray(audio.write_wav(sounds[1])), "z")]
    prints = audio.fingerprints(spark.createDataFrame(rows, "rec_id long, audio binary, fp string")).cache()
    got = audio.match_recordings(prints, prints.where("rec_id % 50 = 0"), block_rows=4, query_rows=2).collect()
    values = {i: audio.fingerprint_wav(bytes(a) if a is not None else None) for i, a, _ in rows if i is not None}
    label = {i: min(j for j, w in values.items() if w.tobytes() == v.tobytes()) for i, v in values.items()}
    assert {(r["rec_id"], r["class_id"]) for r in got if r["kind"] == "member"} == set(label.items())
    expected = set()
    for q in (i for i in values if i % 50 == 0):
        for c in sorted(set(label.values())):
            others = sum(k == c for k in label.values()) - (label[q] == c)
            if others and (best := all_offsets(values[q], values[c])):
                expected.add((q, c, others, best[0], round(best[1], 9), best[2]))
    found = {(r["rec_id"], r["class_id"], r["others"], r["offset"], r["bit_errors"], r["overlap"]) for r in got if r["kind"] == "match"}
    assert found == expected and len(expected) >= 4 and all(r["votes"] >= audio.VOTES for r in got if r["kind"] == "match")
    later = prints.where("rec_id IN (0, 50)").select((prints.rec_id + 1).alias("rec_id"), "fp")
    other = audio.match_recordings(prints, later, among=False).where("kind = 'match'").collect()
    assert {(r["rec_id"], r["class_id"], r["others"], r["offset"]) for r in other} == {(q + 1, c, sum(k == c for k in label.values()), x[0]) for q in (0, 50) for c in set(label.values()) if (x := all_offsets(values[q], values[c]))}
    empty = prints.limit(0)
    assert audio.match_recordings(empty, empty).count() == 0


def test_other_recordings_are_found(spark):
    """What the query asks: each row's noisy, delayed recording finds the class of the row, and nothing else; null and empty vectors find nothing, and silence finds silence."""
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.standard_normal(64)]) for i in range(0, 300, 10)] + [(5, None), (15, []), (25, [float("nan")] * 64)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = audio.match_recordings(audio.fingerprints(audio.sonify(frame)), audio.fingerprints(audio.sonify(frame, delay=200, noise=0.1)), among=False).where("kind = 'match'").collect()
    assert {(r["rec_id"], r["class_id"], r["others"]) for r in got} == {(i, i, 1) for i in [*range(0, 300, 10), 25]} and all(abs(r["offset"]) <= 1 and r["bit_errors"] < 0.15 for r in got)
