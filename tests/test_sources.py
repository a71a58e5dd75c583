"""Record shape, trimming, bad numbers, and files as they come."""

import random

import pytest

from amity import sources
from amity.operators import record_quality
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS
from amity.sources import AT_LEAST_3, AT_LEAST_5, EXACTLY_5, Fields
from amity.sources.delimited import fields_of

USER_LINES = [
    "ID,Name,Nationality,CountryCod,Hobby",
    "1,Ann,India,3,Boxing",
    '2,"Lee, Bo",India,4,Reading',
    "3,Short,India",
    "4,Extra,India,5,Boxing,more",
    "5,EmptyLast,India,6,",
    "6,Trail,India,6,Boxing,,",
    "",
    "7,\tTab\t , India ,zz,Boxing \x01",
    "x8,NoId,India,6,Boxing",
    ",,,,",
    "9,Gap,,,Boxing",
    "10,Far,India,6,Boxing,,x",
    '11,"Say ""Hi"", Bo",India,6,"Boxing",",",',
]


@pytest.fixture
def write(tmp_path):
    def write(lines, end="\r\n"):
        path = tmp_path / "in.csv"
        path.write_bytes((end.join(lines) + end).encode())
        return str(path)

    return write


def names(df):
    return sorted(r.Name for r in df.collect())


class TestUsers:
    @pytest.mark.parametrize("end", ["\r\n", "\n"])
    @pytest.mark.parametrize(
        "fields, want",
        [
            (AT_LEAST_5, ["Ann", "Extra", "Far", "Gap", "Lee, Bo", "NoId", 'Say "Hi", Bo', "Tab", "Trail"]),
            (EXACTLY_5, ["Ann", "Gap", "Lee, Bo", "NoId", "Tab", "Trail"]),
            (AT_LEAST_3, ["Ann", "EmptyLast", "Extra", "Far", "Gap", "Lee, Bo", "NoId", 'Say "Hi", Bo', "Short", "Tab", "Trail"]),
            (Fields(3, 4), ["EmptyLast", "Short"]),
        ],
    )
    def test_shape(self, spark, write, fields, want, end):
        assert names(sources.read_users(spark, write(USER_LINES, end), fields)) == want

    def test_types_and_trimming(self, spark, write):
        df = sources.read_users(spark, write(USER_LINES))
        assert df.schema.simpleString() == USERS.simpleString()
        tab = next(r for r in df.collect() if r.Name == "Tab")
        assert tuple(tab) == (7, "Tab", "India", None, "Boxing")

    def test_unreadable_id_is_null_and_the_row_stays(self, spark, write):
        df = sources.read_users(spark, write(USER_LINES))
        assert [r.ID for r in df.collect() if r.Name == "NoId"] == [None]

    def test_shape_holds_when_one_column_is_asked_for(self, spark, write):
        df = sources.read_users(spark, write(USER_LINES), EXACTLY_5)
        assert df.select("ID").count() == 6

    def test_header_in_every_file_of_a_folder(self, spark, tmp_path):
        for i, first in enumerate([" ID ", "id", '"ID"']):
            (tmp_path / f"{i}.csv").write_text(f"{first},Name,Nationality,CountryCod,Hobby\n{i},N,X,1,H\n")
        assert sources.read_users(spark, str(tmp_path)).count() == 3


class TestOtherTables:
    def test_associates_with_three_fields(self, spark, write, rows):
        path = write(["FriendRel,PersonA_ID,PersonB_ID,DateofFriendship,Desc",
                      "1,1,2,495873,Family", "2,1,3", "3,1"])
        df = sources.read_associates(spark, path)
        assert df.schema.simpleString() == ASSOCIATES.simpleString()
        assert rows(df) == [(1, 1, 2, 495873, "Family"), (2, 1, 3, None, None)]

    def test_access_times(self, spark, write, rows):
        path = write(["AccessId,ByWho,WhatPage,TypeOfAccess,AccessTime",
                      "1,1,2,Poked,abc", "2,1,2,Poked,", "3,1,2,Poked, 7 ", "4,1,2,Poked,5.0",
                      "5,1,2,Poked,+5", "6,1,2,Poked,99999999999999999999", "7,1,2,Poked,-4"])
        got = sources.read_access_logs(spark, path, EXACTLY_5).select("AccessId", "AccessTime")
        assert rows(got) == [(1, None), (3, 7), (4, None), (5, 5), (6, None), (7, -4)]

    def test_record_quality(self, spark, write, rows):
        path = write(["AccessId,ByWho,WhatPage,TypeOfAccess,AccessTime",
                      "1,1,2,Poked,abc", "2,1,2,Poked,", "3,1,2,Poked, 7 ", "4,1,2", "5,1,2,P,8,more"])
        assert rows(record_quality(sources.read_raw(spark, path, ACCESS_LOGS))) == [(5, 3, 1)]


class TestLines:
    def test_same_shape_as_from_a_file(self, spark, write, rows):
        lines = spark.createDataFrame([(l,) for l in USER_LINES[1:]], "value string")
        for fields in (AT_LEAST_5, EXACTLY_5, AT_LEAST_3):
            file = sources.read_users(spark, write(USER_LINES), fields)
            got = sources.typed(sources.raw_from_lines(lines, USERS), USERS, fields)
            assert rows(got) == rows(file)

    def test_empty_field_inside_is_empty_text(self, spark, write, rows):
        path = write(["9,Gap,,,Boxing", '9,"Gap",,,Boxing'])
        assert rows(sources.read_users(spark, path)) == [(9, "Gap", "", None, "Boxing")] * 2

    def test_a_line_is_split_once(self, spark, write):
        df = sources.read_access_logs(spark, write(["1,1,2,Poked,5"]), EXACTLY_5)
        df = df.where("ByWho IS NOT NULL AND AccessTime > 3")
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        splitting = [step for step in plan if "split(" in step]
        assert len(splitting) == 1 and "Generate explode" in splitting[0]
        assert any("Filter" in step and "AccessTime" not in step for step in plan)

    @pytest.mark.parametrize("line, want", [
        ('1,"Al,India,3,Boxing', ["1", '"Al', "India", "3", "Boxing"]),
        ('3,6" Bo,India,3,"Box', ["3", '6" Bo', "India", "3", '"Box']),
        ('1,"a ""q"", b",India,1,x', ["1", 'a "q", b', "India", "1", "x"]),
        ('1, "b" ,c,d,e', ["1", '"b"', "c", "d", "e"]),
        ('1,a,b,c,"d,e', ["1", "a", "b", "c", '"d']),
        ('4,6" Bo,India,3,"Box,x', ["4", '6" Bo', "India", "3", '"Box']),
        ('1,"x"y,z,"",', ["1", "xy", "z", None, None]),
        ('"1","2","3","4","5"', ["1", "2", "3", "4", "5"]),
        ('1,back\\slash "q",z,"a\\",b', ["1", 'back\\slash "q"', "z", "a\\", "b"]),
    ])
    def test_quotes(self, spark, line, want):
        row = sources.raw_from_lines(spark.createDataFrame([(line,)], "value string"), USERS).first()
        got = [None if v is None else v.strip() for v in row[:5]]
        assert got == want
        assert row.n_fields == {'1,a,b,c,"d,e': 6, '4,6" Bo,India,3,"Box,x': 6}.get(line, sum(v is not None for v in want))

    def test_split_merged(self, spark, rows):
        lines = spark.createDataFrame(
            [("1,1,2",), ("1,1,2,Viewed,9",), ("1,1,2,3",), ("h,a,b",), ("5,6,7,,",),
             ("FriendRel,PersonA_ID,PersonB_ID",), ("AccessId,ByWho,WhatPage,TypeOfAccess,AccessTime",),
             ("FriendRel,PersonA_ID,PersonB_ID,DateofFriendship,Desc",)], "value string"
        )
        split = sources.split_merged(lines)
        assert rows(split.where("kind = 'friendship'").select("friendship.*")) == [(1, 1, 2), (5, 6, 7), (None, None, None)]
        assert rows(split.where("kind = 'access'").select("access.*")) == [(1, 1, 2, "Viewed", 9)]
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate explode") == 1


def plain_fields(line):
    """Character by character: a field in quotes up to the quote that is not doubled, else up to the comma."""
    fields, i = [], 0
    while True:
        field, end = "", i
        if line[i : i + 1] == '"':
            j = i + 1
            while j < len(line) and (line[j] != '"' or line[j : j + 2] == '""'):
                field += line[j]
                j += 2 if line[j] == '"' else 1
            end = j + 1 if j < len(line) else None
        if end is None:  # never closed: text
            field, end = "", i
        comma = line.find(",", end)
        field += line[end : comma if comma >= 0 else None]
        fields.append(field)
        if comma < 0:
            break
        i = comma + 1
    while len(fields) > 1 and not fields[-1]:
        fields.pop()
    return fields


def test_fields_of_any_line(spark):
    rng = random.Random(4)
    lines = ["".join(rng.choice(['"', '""', ",", ',"', '",', "a", "(", ")", "$1", "\\", " "]) for _ in range(rng.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = df.select("value", fields_of(df.value).alias("fields")).collect()
    for value, fields in got:
        assert fields == plain_fields(value), value
