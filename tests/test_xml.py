"""XML metadata."""

import pytest

from chunkloom.jobs.records import xml_fields
from chunkloom.operators import records


def test_fields_of_one_parse_and_malformed_text(spark):
    docs = spark.createDataFrame([('<Image ID="5"><Pixels Unit="nm" SizeX="1.5"/><Channel Name="a&amp;b"/></Image>',), ('<Image ID="6"><Pixels Unit=""/></Image>',), (None,)], "t string")
    image = records.parsed_xml("t", "_ID long, Pixels struct<_Unit string, _SizeX double>, Channel struct<_Name string>")
    got = docs.select(image.alias("i")).select("i._ID", "i.Pixels._Unit", "i.Pixels._SizeX", "i.Channel._Name").collect()
    assert [tuple(r) for r in got] == [(5, "nm", 1.5, "a&b"), (6, "", None, None), (None, None, None, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        spark.createDataFrame([('<Image ID="5"',)], "t string").select(records.parsed_xml("t", "_ID long")).collect()


def test_rows_are_parsed_in_as_many_tasks_as_a_shuffle_has(spark):
    assert xml_fields(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
