"""Sinks and the tasks from files to files."""

import glob
import gzip

import pytest
from pyspark.errors import AnalysisException

from amity import generate, sinks
from amity.__main__ import main
from amity.plans import tasks
from amity.schemas import USERS
from amity.sources import read_access_logs, read_associates, read_merged_lines, read_users, split_merged


def text(path):
    found = []
    for part in glob.glob(f"{path}/part-*"):
        opened = gzip.open(part, "rt") if part.endswith(".gz") else open(part)
        with opened as f:
            found += f.read().splitlines()
    return found


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture
def files(tmp_path):
    def write(name, lines):
        path = tmp_path / name
        path.write_bytes(("\r\n".join(lines) + "\r\n").encode())
        return str(path)

    return {
        "users": write("users.csv", [
            "ID,Name,Nationality,CountryCod,Hobby",
            "1,Ann,India,3,Boxing", "2, Bo , india ,3,Reading", "3,Cy,Cuba,4,Boxing,more", "4,Di,Fiji",
        ]),
        "associates": write("associates.csv", [
            "FriendRel,PersonA_ID,PersonB_ID,DateofFriendship,Desc",
            "1,1,2,5,Family", "2,1,3,5,Family", "3,2,3,5,Friend", "4,2",
        ]),
        "logs": write("logs.csv", [
            "AccessId,ByWho,WhatPage,TypeOfAccess,AccessTime",
            "1,1,2,Viewed,100", "2,1,2,Viewed,7776000100", "3,10,4,Poked,99", "4,9,4,Poked,abc",
            "5,9,4", "6,2,8,Poked,100,more",
        ]),
        "merged": write("merged.csv", ["1,1,2", "2,1,3", "3,2,3", "1,1,2,Viewed,100", "3,9,4,Poked,99"]),
    }


class TestSinks:
    @pytest.fixture
    def df(self, spark):
        return spark.createDataFrame([(1, 'a "q"', None), (2, "b,c", "d")], "k int, x string, y string")

    def test_tab_is_the_default(self, df, out):
        sinks.write_text(df, out)
        assert sorted(text(out)) == ['1\ta "q"\t', "2\tb,c\td"]

    def test_separators(self, df, out):
        sinks.write_text(df, out, sep=":", value_sep=";")
        assert sorted(text(out)) == ['1:a "q";', "2:b,c;d"]

    def test_key_only(self, df, out):
        sinks.write_text(df.select("k"), out)
        assert sorted(text(out)) == ["1", "2"]

    def test_named_output(self, df, out):
        sinks.write_text(df.select("k"), out, name="keys")
        assert sorted(text(f"{out}/keys")) == ["1", "2"]

    def test_gzip(self, df, out):
        sinks.write_text(df.select("k"), out, compression="gzip")
        parts = glob.glob(f"{out}/part-*")
        assert parts and all(p.endswith(".txt.gz") for p in parts)
        assert sorted(text(out)) == ["1", "2"]

    def test_modes(self, df, out):
        sinks.write_text(df, out)
        with pytest.raises(AnalysisException):
            sinks.write_text(df, out)
        sinks.write_text(df.select("k").limit(1), out, mode="overwrite")
        assert len(text(out)) == 1

    def test_tables_come_back(self, spark, out, rows):
        made = {
            "users": generate.generate_users(spark, 50),
            "associates": generate.generate_associates(spark, 50, 200),
            "logs": generate.generate_access_logs(spark, 100, 50),
        }
        for (name, df), read in zip(made.items(), (read_users, read_associates, read_access_logs)):
            sinks.write_table(df, f"{out}/{name}")
            back = read(spark, f"{out}/{name}")
            assert rows(back) == rows(df)
            assert back.dtypes == df.dtypes

    def test_any_text_comes_back(self, spark, out, rows):
        df = spark.createDataFrame([
            (1, 'a "q", b', "India", 1, "x"), (2, "back\\slash, z", "a\\", 2, '"'), (3, '"all"', "b,c", 3, '""'),
            (4, "6\" Bo", "d", 4, ',"'), (5, "\\\"", "e", None, "plain"),
        ], USERS)
        sinks.write_table(df, out)
        assert rows(read_users(spark, out)) == rows(df)


class TestTasks:
    def test_a(self, spark, files, out):
        tasks.task_a(spark, files["users"], out)
        assert text(out) == ["Ann\tBoxing"]
        tasks.task_a(spark, files["users"], out, alternative=True)
        assert sorted(text(out)) == ["Ann\tBoxing", "Bo\tReading"]

    def test_b(self, spark, files, out):
        tasks.task_b(spark, files["users"], files["logs"], out)
        assert text(out) == ["4\tUnknown,Unknown,3", "2\tBo,india,2", "8\tUnknown,Unknown,1"]
        tasks.task_b(spark, files["users"], files["logs"], f"{out}2", k=1, alternative=True)
        assert text(f"{out}2") == ["4\tDi,Fiji,3"]
        tasks.task_b(spark, files["users"], files["logs"], out, k=1)
        with pytest.raises(AnalysisException):
            tasks.task_b(spark, files["users"], files["logs"], out, alternative=True)

    def test_c(self, spark, files, out):
        tasks.task_c(spark, files["users"], out)
        assert sorted(text(out)) == ["India\t1", "india\t1"]
        assert all(p.endswith(".gz") for p in glob.glob(f"{out}/part-*"))
        tasks.task_c(spark, files["users"], f"{out}2", alternative=True)
        assert sorted(text(f"{out}2")) == ["India\t1", "india\t1"]

    def test_d(self, spark, files, out):
        tasks.task_d(spark, files["users"], files["associates"], out)
        assert sorted(text(out)) == ["Ann,2", "Bo,2", "Cy,2"]
        tasks.task_d(spark, files["users"], files["associates"], out, alternative=True)
        assert sorted(text(out)) == ["Ann,2", "Bo,2", "Cy,2", "Di,0"]

    def test_e(self, spark, files, out):
        want = ["1\tTotalAccesses: 2, DistinctPages: 1", "2\tTotalAccesses: 1, DistinctPages: 1",
                "9\tTotalAccesses: 1, DistinctPages: 1", "10\tTotalAccesses: 1, DistinctPages: 1"]
        tasks.task_e(spark, files["logs"], out)
        assert sorted(text(out)) == sorted(want)
        tasks.task_e(spark, files["logs"], f"{out}2", alternative=True)
        parts = sorted(glob.glob(f"{out}2/part-*"))
        assert [line for p in parts for line in open(p).read().splitlines()] == want

    def test_f(self, spark, files, out):
        tasks.task_f(spark, files["associates"], files["logs"], out)
        assert sorted(text(out)) == ["1\tNever Accessed Friend’s Page", "2\tNever Accessed Friend’s Page"]
        tasks.task_f_alternative(spark, files["merged"], f"{out}2")
        assert text(f"{out}2") == ["2\tNever Accessed"]

    def test_g(self, spark, files, out):
        tasks.task_g(spark, files["logs"], out, as_of=7_776_000_100)
        assert text(f"{out}/inactivePersons") == ["10"]
        tasks.task_g(spark, files["logs"], f"{out}2", as_of=200, window=50, order="numeric")
        assert text(f"{out}2/inactivePersons") == ["10"]
        tasks.task_g_minutes(spark, files["logs"], f"{out}3", now=100 * 60 + 90 * 86_400)
        assert text(f"{out}3/inactivePersons") == ["10"]

    def test_order(self, spark, files, out):
        tasks.task_h(spark, files["associates"], out, users=files["users"], order="numeric")
        parts = sorted(glob.glob(f"{out}/part-*"))
        assert [line.split("\t")[0] for p in parts for line in open(p).read().splitlines()] == ["1", "2", "3", "4"]

    def test_h(self, spark, files, out):
        tasks.task_h(spark, files["associates"], out)
        assert sorted(text(out)) == ["1\tMore Popular", "2\tNot More Popular"]
        tasks.task_h(spark, files["associates"], f"{out}2", users=files["users"])
        assert sorted(text(f"{out}2")) == [
            "1\tMore Popular", "2\tNot More Popular", "3\tNot More Popular", "4\tNot More Popular",
        ]

    def test_command_line(self, spark, files, out):
        main(["generate", "--n-users", "30", "--n-associates", "100", "--n-logs", "60", "--out", out])
        tables = [f"--users={out}/users", f"--associates={out}/associates", f"--logs={out}/access_logs"]
        main(["quality", *tables, f"--out={out}/quality"])
        assert text(f"{out}/quality/records") == ["60\t0\t0"]
        assert sorted(text(f"{out}/quality/rows")) == ["access_logs\t60", "associates\t100", "users\t30"]
        assert len(text(f"{out}/quality/violations")) == 9
        main(["task-g", tables[2], "--as-of", "99999999999", f"--out={out}/g"])
        main(["task-g", tables[2], "--as-of", "2000000", "--window", "1500000", "--order", "text", f"--out={out}/g2"])
        main(["task-g-minutes", tables[2], "--now", "1e9", f"--out={out}/g3"])
        main(["task-d", *tables[:2], f"--out={out}/d", "--alternative"])
        assert len(text(f"{out}/d")) == 30
        assert sum(int(line.split(",")[1]) for line in text(f"{out}/d")) == 200


def test_quality_counts_rows_of_any_shape(spark, files, out):
    main(["quality", f"--users={files['users']}", f"--associates={files['associates']}", f"--logs={files['logs']}", f"--out={out}"])
    assert sorted(text(f"{out}/rows")) == ["access_logs\t6", "associates\t4", "users\t4"]


class TestOutputs:
    def test_one_write_for_all_outputs(self, spark, out):
        df = spark.createDataFrame(
            [(1, "a", None, ["main", "x"]), (2, None, None, ["main"]), (3, "b", 4, ["x"]), (4, "c", 5, []), (None, None, None, ["x"])],
            "k int, v string, w int, output array<string>",
        )
        sinks.write_outputs(df, out, "1", value_sep=",")
        assert sorted(text(f"{out}/run=1/output=main")) == ["1\ta", "2"]
        assert sorted(text(f"{out}/run=1/output=x")) == ["", "1\ta", "3\tb,4"]

    def test_a_rerun_replaces_its_own_part(self, spark, out):
        df = spark.createDataFrame([(1, "main"), (2, "gone")], "k int, output string")
        sinks.write_outputs(df, out, "1")
        sinks.write_outputs(df, out, "2")
        sinks.write_outputs(df.where("k = 1"), out, "1")
        assert glob.glob(f"{out}/run=1/output=gone") == [], "nothing is left of an output that is empty now"
        assert text(f"{out}/run=1/output=main") == ["1"] and text(f"{out}/run=2/output=gone") == ["2"]

    def test_task_g(self, spark, files, out):
        counts = tasks.task_g_outputs(spark, files["logs"], out, as_of=7_776_000_100)
        assert counts == {"rows": 6, "wrong_arity": 2, "invalid_time": 1}
        assert sorted(text(f"{out}/run=7776000100/output=main")) == ["1\t7776000100", "10\t99"]
        assert text(f"{out}/run=7776000100/output=inactivePersons") == ["10"]
        tasks.task_g_outputs(spark, files["logs"], out, as_of=50)
        tasks.task_g_outputs(spark, files["logs"], out, as_of=7_776_000_100, window=10**12)
        assert sorted(p.rsplit("/", 2)[1:] for p in glob.glob(f"{out}/run=*/output=*")) == [
            ["run=50", "output=main"], ["run=7776000100", "output=main"],
        ]

    def test_command_line(self, spark, files, out, capsys):
        main(["task-g-outputs", f"--logs={files['logs']}", "--as-of", "7776000100", f"--out={out}/g"])
        assert '{"rows": 6, "wrong_arity": 2, "invalid_time": 1}' in capsys.readouterr().out
        main(["rejected", f"--logs={files['logs']}", f"--out={out}/bad"])
        assert sorted(text(f"{out}/bad")) == [
            "AccessTime\t5\t4,9,4,Poked,abc", "wrong number of fields\t3\t5,9,4", "wrong number of fields\t6\t6,2,8,Poked,100,more",
        ]


class TestMixedFiles:
    """Friendships with all their five columns beside accesses."""

    @pytest.fixture
    def mixed(self, tmp_path):
        folder = tmp_path / "mixed"
        folder.mkdir()
        (folder / "friends-1.csv").write_text(
            "FriendRel,PersonA_ID,PersonB_ID,DateofFriendship,Desc\n1,1,2,5,Family\n2,1,3,5,Family\n3,2,3,5,Friend\n4,2\n5,4,1\n"
        )
        (folder / "accesses-1.csv").write_text(
            "AccessId,ByWho,WhatPage,TypeOfAccess,AccessTime\n1,1,2,Viewed,100\n2,9,4,Poked,99\n3,2,3\n4,4,1,Poked\n"
        )
        return str(folder)

    def test_told_by_file(self, spark, mixed, rows):
        lines = read_merged_lines(spark, mixed)
        got = split_merged(lines, lines.file.startswith("friends"))
        assert rows(got.where("kind = 'friendship'").select("friendship.*")) == [
            (1, 1, 2, 5, "Family"), (2, 1, 3, 5, "Family"), (3, 2, 3, 5, "Friend"), (5, 4, 1, None, None),
        ]
        assert rows(got.where("kind = 'access'").select("access.*")) == [(1, 1, 2, "Viewed", 100), (2, 9, 4, "Poked", 99)]
        # By the number of fields they are taken for accesses.
        assert split_merged(lines).where("kind = 'friendship'").count() == 2

    def test_owners(self, spark, mixed, out):
        tasks.task_f_alternative(spark, mixed, out, friend_files="^friends-")
        assert sorted(text(out)) == ["2\tNever Accessed", "4\tNever Accessed"]
        main(["task-f-alternative", f"--merged={mixed}", "--friend-files", "friends", f"--out={out}2"])
        assert sorted(text(f"{out}2")) == sorted(text(out))
