"""Extended XYZ by byte ranges equals the whole-file parse wherever the file is cut."""

import random

import pytest

from lacuna.sources import frames, readers


def written(seed, n=40, tricky=False):
    """Frames with blank lines between; tricky ones have headers that look like the beginning of a frame."""
    rng, out = random.Random(seed), []
    for k in range(n):
        atoms = rng.randint(0 if tricky else 1, 4)
        header = f'Lattice="4 0 0 0 4 0 0 0 4" Properties=species:S:1:pos:R:3 main={k} energy={k}.5'
        out.append(str(atoms) + rng.choice(["", " ", "\r"]))
        out.append(rng.choice([header, "1", "2"]) if tricky else header)
        out += [f"Si {k} {i} 0.{i}" for i in range(atoms)]
        out += [""] * rng.choice([0, 0, 1, 2])
    return "\n".join(out) + rng.choice(["", "\n"])


def put(folder, name, text):
    (folder / name).write_bytes(text.encode())
    return str(folder / name)


def plain(text):
    return [(f["structure_id"], f["n_atoms"], f["symbols"], f["positions"], f["energy"]) for f in readers.parse_frames(text)]


def fields(df):
    return [(r.structure_id, r.n_atoms, r.symbols, r.positions, r.energy) for r in df.orderBy("structure_id").collect()]


@pytest.mark.parametrize("tricky", [False, True])
def test_ranges_tell_their_frames_at_every_cut(tmp_path, tricky):
    """Every cut place, without Spark: what the reader of the range before tells is where the range's frames begin."""
    text = written(1, 12, tricky)
    path = put(tmp_path, "a.xyz", text)
    size, starts = len(text.encode()), None
    with frames.opened(path) as file:
        starts = [at for at, lines in frames.frames_in(file, 0, size) if lines]
        wrong = 0
        for cut in range(1, size):
            told = [at for at, _ in frames.frames_in(file, 0, cut)][-1]
            here = [at for at, lines in frames.frames_in(file, told, size) if lines]
            assert here == [x for x in starts if x >= cut]
            guess = frames.guessed(file, cut, size)
            wrong += guess is not None and guess != told
        assert tricky or not wrong


@pytest.mark.parametrize("range_bytes", [61, 1000, 10**6])
@pytest.mark.parametrize("tricky", [False, True])
def test_equal_to_whole_file(spark, tmp_path, range_bytes, tricky):
    text = written(2, 9 if range_bytes < 50 else 40, tricky)
    path = put(tmp_path, "a.xyz", text)
    assert fields(readers.read_extxyz(spark, path, range_bytes)) == plain(text)


def test_many_tasks_and_files(spark, tmp_path):
    texts = {"a.xyz": written(3, 60), "b.xyz": written(4, 30, True), "empty.xyz": "", "one.xyz": written(5, 1)}
    for name, text in texts.items():
        put(tmp_path, name, text)
    put(tmp_path, "_hidden", "no frame")
    df = readers.read_extxyz(spark, str(tmp_path), 300)
    got = {}
    for r in df.collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.structure_id, r.n_atoms, r.symbols, r.positions, r.energy))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(v) for k, v in texts.items() if v}
    index = frames.frame_index(spark, str(tmp_path), 300)
    assert frames.load(spark, str(tmp_path), 300).rdd.getNumPartitions() == index.count() > 8
    assert fields(readers.read_extxyz_whole(spark, str(tmp_path / "a.xyz"))) == plain(texts["a.xyz"])


def test_errors(spark, tmp_path):
    for text in ("3\nx\nSi 0 0 0\n", "1\nx\nSi 0 0 0\n\nno number\n"):
        path = put(tmp_path, "bad.xyz", text)
        for range_bytes in (4, 1000):
            with pytest.raises(Exception, match="cut off|no number"):
                readers.read_extxyz(spark, path, range_bytes).collect()
    with pytest.raises(FileNotFoundError):
        frames.listed(str(tmp_path / "none.xyz"))
