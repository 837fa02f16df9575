"""Stores, builds and loops that are killed at every step and gone on with give what an undisturbed run gives."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lacuna.plans import build
from lacuna.plans.flows import Stopped, stop_at
from lacuna.sources.readers import read_descriptors
from lacuna.sources.store import FileStore
from lacuna.streaming.generations import Generations, LimitMemory, Position, limits, next_position

# ---- store


def put(path, rows):
    path.write_text("".join(f"#start {len(s)}\n" + "".join(f"{t} {x} {y}\n" for t, x, y in s) for s in rows))


def contents(store):
    return sorted((os.path.basename(r.file), r.structure_id, r.atom_idx, r.elem, *r.features) for r in store.read().collect())


def test_store_parses_changed_files_alone(spark, tmp_path):
    files = tmp_path / "out"
    files.mkdir()
    for name in ("a b.out", "c.out", "d.out"):
        put(files / name, [[(0, 1.0, 2.0), (1, 3.0, 4.0)], [(0, 5.0, 6.0)]])
    asked, tasks = [], []

    def parse(session, paths):
        asked.append(sorted(os.path.basename(p) for p in paths))
        return read_descriptors(session, paths)

    store = FileStore(spark, str(tmp_path / "store"), parse)
    with pytest.raises(ValueError):
        store.read()

    def update():
        group = f"update-{len(tasks)}"
        spark.sparkContext.setJobGroup(group, group)
        done = store.update(str(files))
        status = spark.sparkContext.statusTracker()
        stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
        tasks.append(sum(i.numTasks for s in stages if (i := status.getStageInfo(s))))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return done

    first = update()
    assert len(first.parsed) == 3 and (first.kept, first.gone) == (0, 0) and len(contents(store)) == 9
    parts = {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "store" / "rows").rglob("*.parquet"))}
    second = update()
    assert second == ([], 3, 0) and len(asked) == 1 and tasks[1] < tasks[0]
    time.sleep(0.01)
    put(files / "c.out", [[(7, 8.0, 9.0)]])
    os.remove(files / "d.out")
    third = update()
    assert [os.path.basename(p) for p in third.parsed] == ["c.out"] == asked[1] and (third.kept, third.gone) == (1, 1)
    assert [r for r in contents(store) if r[0] == "c.out"] == [("c.out", 0, 0, 7, 8.0, 9.0)] and {r[0] for r in contents(store)} == {"a%20b.out", "c.out"}
    left = {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "store" / "rows").rglob("*.parquet"))}
    assert sum(parts.get(p) == t for p, t in left.items()) == len(left) - 1  # the unchanged file's rows were not touched


def test_store_after_an_update_that_died(spark, tmp_path):
    files = tmp_path / "out"
    files.mkdir()
    put(files / "a.out", [[(0, 1.0, 2.0)]])
    store = FileStore(spark, str(tmp_path / "store"))
    store.update(str(files))
    before = contents(store)
    time.sleep(0.01)
    put(files / "a.out", [[(1, 3.0, 4.0)]])

    class Dies(FileStore):
        def versions(self):
            if os.path.isdir(tmp_path / "store" / "rows") and len(os.listdir(tmp_path / "store" / "rows")) > 3:
                raise Stopped
            return super().versions()

    import contextlib

    with contextlib.suppress(Stopped):
        Dies(spark, str(tmp_path / "store")).update(str(files))
    assert contents(store) == before or contents(store)[0][3] == 1
    store.update(str(files))
    assert [r[3:] for r in contents(store)] == [(1, 3.0, 4.0)]


# ---- build

CELL = [4.0, 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 4.0]
SCHEMA = "structure_id long, n_atoms int, cell array<double>, symbols array<string>, positions array<array<double>>"
SETTINGS = build.Settings(strains=(1.0, 1.02), rattle_count=1, seed=3, every=5, phonon_length=0.01, force_threshold=2.0)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(i, 2, CELL, ["Si", "Ge"], [[0.0, 0.0, 0.0], [1.0, 2.0, i / 8]]) for i in (5, 9)], SCHEMA)


def made(spark, base, folder, settings=SETTINGS, before=None, reuse=True):
    steps = spark.createDataFrame([(0,), (5,), (7,)], "step int")
    sites = base.select("structure_id", F.lit(1).alias("atom_idx"), "cell", F.array(F.array(*[F.lit(x) for x in (1, 0, 0, 0, 1, 0, 0, 0, 1)])).alias("rotations"))
    labels = lambda c: c.withColumn("forces", F.array(F.array(F.col("structure_id").cast("double"), F.lit(0.0), F.lit(0.0))))
    return build.ensure_dataset(spark, folder, base, settings, base.crossJoin(steps), sites, labels, reuse, before)


def rows(df):
    return sorted((r.structure_id, r.kind, r.n_atoms, str(r.positions), str(r.cell)) for r in df.collect())


def test_build_goes_on_after_each_stage(spark, base, tmp_path):
    whole = made(spark, base, str(tmp_path / "whole"))
    names = ["source", "random_displacement", "phonon_displacement", "trajectory", "candidates", "labelled"]
    assert whole.made == names and whole.counts == {"source": 2, "random_displacement": 8, "phonon_displacement": 12, "trajectory": 4, "candidates": 20, "labelled": 2}
    again = made(spark, base, str(tmp_path / "whole"))
    assert again.reused and rows(again.table) == rows(whole.table)
    for i, name in enumerate(names):
        step = f"mark of {name}" if i % 2 else name  # before a stage, and between its table and its mark
        folder = str(tmp_path / step.replace(" ", "_"))
        with pytest.raises(Stopped):
            made(spark, base, folder, before=stop_at({step}))
        rest = made(spark, base, folder)
        assert rest.found == names[:i] and rest.made == names[i:], step
        assert rows(rest.table) == rows(whole.table) and rest.counts == whole.counts, step
    assert made(spark, base, str(tmp_path / "whole"), reuse=False).made == names
    other = made(spark, base, str(tmp_path / "whole"), build.Settings(strains=(1.0,)))
    assert "random_displacement" in other.made  # other settings are another build


# ---- generations


def choose(batch, seen, at):
    users = batch.select("user").distinct()
    return users if seen is None else users.join(seen.select("user"), "user", "left_anti")


USERS = {(0, 0): [1, 2, 3], (0, 1): [2, 4], (0, 2): [4, 5, 6], (1, 0): [7], (1, 1): [7], (1, 2): [8], (2, 0): [8, 9], (2, 1): [10, 11, 12], (2, 2): [13]}


def draw(spark):
    return lambda at: spark.createDataFrame([(u,) for u in USERS[at]], "user int")


def state(loop):
    history = sorted(tuple(r) for r in loop.history().collect())
    training = loop.training()
    return history, sorted((r.main, r.gen, r.from_main, r.from_gen, r.user) for r in training.collect()) if training is not None else []


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    loop = Generations(spark, str(tmp_path_factory.mktemp("loop")), 3, 3, 4, choose)
    ran = loop.run(draw(spark))
    return ran, state(loop)


def test_generations(undisturbed):
    ran, (history, training) = undisturbed
    # the loop of main 1 ends in its second generation, which selects nobody
    assert ran == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2)]
    assert [(m, g, s, n, p, f) for m, g, s, n, p, f in history] == [
        (0, 0, "done", 3, 3, 0), (0, 1, "done", 1, 0, 4), (0, 2, "done", 2, 2, 0), (1, 0, "done", 1, 3, 0), (1, 1, "ended", 0, 3, 0), (2, 0, "done", 2, 0, 5), (2, 1, "done", 3, 3, 0), (2, 2, "done", 1, 0, 4),
    ]
    assert sorted(u for *_, u in training) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


@pytest.mark.parametrize(("step", "nth"), [("select", 3), ("flush", 1), ("done", 5)])
def test_killed_at_a_step(spark, tmp_path, undisturbed, step, nth):
    times = []

    def before(name):
        times.append(name)
        if times.count(step) == nth and name == step:
            raise Stopped(step)

    loop = Generations(spark, str(tmp_path / "loop"), 3, 3, 4, choose, before)
    with pytest.raises(Stopped):
        loop.run(draw(spark))
    again = Generations(spark, str(tmp_path / "loop"), 3, 3, 4, choose)
    again.run(draw(spark))
    assert state(again) == undisturbed[1]
    assert next_position(again.history(), 3, 3).count() == 0
    assert again.step(Position(1, 1), draw(spark)((0, 0))) == "ended" and state(again) == undisturbed[1]


def test_generations_of_a_stream(spark, tmp_path, undisturbed):
    """Each micro-batch is a generation, once, also where the stream begins anew without its checkpoint."""
    source = tmp_path / "in"
    for i, at in enumerate([(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2)]):
        draw(spark)(at).coalesce(1).write.mode("append").parquet(str(source))
        time.sleep(0.02)
    stream = lambda: spark.readStream.schema("user int").option("maxFilesPerTrigger", 1).parquet(str(source))
    died = Generations(spark, str(tmp_path / "loop"), 3, 3, 4, choose, stop_at({"done"}))
    query = died.attach(stream(), str(tmp_path / "check"))
    with pytest.raises(Exception, match="done"):
        query.awaitTermination()
    loop = Generations(spark, str(tmp_path / "loop"), 3, 3, 4, choose)
    loop.attach(stream(), str(tmp_path / "check")).awaitTermination()
    assert state(loop) == undisturbed[1]
    loop.attach(stream(), str(tmp_path / "new check")).awaitTermination()  # replays every batch
    assert state(loop) == undisturbed[1]


# ---- limits


def test_limits(spark, tmp_path):
    flags = [True, True, False, True, False, True]
    memory = LimitMemory(spark, str(tmp_path / "limits"), 0.2)
    plain = LimitMemory(spark, str(tmp_path / "plain"), 0.2, first_is_lost=False)
    for gen, flag in enumerate(flags):
        for _ in range(2):  # a generation that runs again sees and leaves the same
            assert abs(memory.limit(gen) - 0.2 * (1 + sum(flags[1:gen]))) < 1e-12
            assert abs(plain.limit(gen) - 0.2 * (1 + sum(flags[:gen]))) < 1e-12
            memory.record(gen, flag)
            plain.record(gen, flag)
    records = spark.createDataFrame([("k", g, f if t else not f, t) for g, f in enumerate(flags) for t in (0, 1)], "key string, gen int, label boolean, at int")
    got = {r.gen: r.limit for r in limits(records, 0.2, key=["key"]).collect()}
    assert got == pytest.approx({g: 0.2 * (1 + sum(flags[1:g])) for g in range(len(flags))})
