"""Fixed schemas: solution tables, rule tables, and the canonical column names
the operators work on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical observation / series attributes (what every source must provide).
# ---------------------------------------------------------------------------
SERIES_ATTRS = [
    "object",           # child name, parent name when the child is blank
    "child_name",
    "parent_name",
    "child_class",
    "parent_class",
    "child_category",
    "parent_category",
    "property",
    "unit",
    "key_id",
    "band",
    "timeslice_id",
    "timeslice",
]

# Block key carried by every cell: a rule, an optional component of a stacked
# rule, the timeslice and an optional parent (nested rules).
BLOCK_KEYS = ["rule_ord", "component", "timeslice_id", "timeslice", "parent"]

# ---------------------------------------------------------------------------
# Solution layout (the simulator's Parquet export). The column names and
# types here and in the rule tables below are those of the data.
# ---------------------------------------------------------------------------
FACT = T.StructType([
    T.StructField("SeriesId", T.LongType()),
    T.StructField("PeriodId", T.IntegerType()),
    T.StructField("Value", T.DoubleType()),
    T.StructField("EpochId", T.LongType()),
])

FULLKEYINFO = T.StructType([
    T.StructField("KeyId", T.LongType()),
    T.StructField("SeriesId", T.LongType()),
    T.StructField("DataFileId", T.IntegerType()),
    T.StructField("BandId", T.IntegerType()),
    T.StructField("ParentObjectCategoryName", T.StringType()),
    T.StructField("ParentObjectName", T.StringType()),
    T.StructField("ChildObjectCategoryName", T.StringType()),
    T.StructField("ChildObjectName", T.StringType()),
    T.StructField("ParentClassName", T.StringType()),
    T.StructField("ChildClassName", T.StringType()),
    T.StructField("PropertyName", T.StringType()),
    T.StructField("UnitValue", T.StringType()),
    T.StructField("TimesliceId", T.IntegerType()),
    T.StructField("TimesliceName", T.StringType()),
])

PERIOD = T.StructType([
    T.StructField("PeriodEpochId", T.LongType()),
    T.StructField("EpochId", T.LongType()),
    T.StructField("PeriodId", T.IntegerType()),
    T.StructField("StartDate", T.TimestampType()),
    T.StructField("EndDate", T.TimestampType()),
    T.StructField("PeriodTypeId", T.IntegerType()),
    T.StructField("OriginalPeriodId", T.IntegerType()),
])

# The tables of a solution export and the columns and types of each. ``data`` is
# the fact, with its partition column.
SOLUTION_TABLES = {
    "aggregatedseries": "SeriesId BIGINT, Sum DOUBLE, Min DOUBLE, Max DOUBLE, ValueCount INT, StandardDeviation DOUBLE, Mode DOUBLE, "
                        "Median DOUBLE, FirstQuartile DOUBLE, ThirdQuartile DOUBLE, SeriesHash STRING",
    "attribute": "AttributeId INT, ClassId INT, Description STRING, InputMask STRING, EnumId INT, LangId INT, Name STRING",
    "attributedata": "AttributeId INT, ObjectId INT, Value DOUBLE",
    "category": "CategoryId INT, ClassId INT, Name STRING, Rank INT",
    "class": "ClassGroupId INT, ClassId INT, LangId INT, Name STRING, InheritsFrom INT",
    "classgroup": "ClassGroupId INT, LangId INT, Name STRING",
    "collection": "ChildClassId INT, CollectionId INT, ComplementName STRING, LangId INT, Name STRING, ParentClassId INT, Rank INT",
    "config": "Element STRING, Value STRING",
    "customcolumn": "ClassId INT, ColumnId INT, Name STRING, Position INT, UniqueId STRING",
    "data": "SeriesId BIGINT, PeriodId INT, Value DOUBLE, EpochId BIGINT, dataFileId BIGINT",
    "fullkeyinfo": "KeyId BIGINT, PhaseId INT, PhaseName STRING, BandId INT, PeriodTypeId INT, PeriodTypeName STRING, SeriesId BIGINT, "
                   "DataFileId INT, RowGroupIndex INT, ParentObjectCategoryName STRING, ParentObjectId INT, ParentObjectName STRING, "
                   "ChildObjectCategoryName STRING, ChildObjectId INT, ChildObjectName STRING, ParentClassId INT, ParentClassLangId INT, "
                   "ParentClassName STRING, CollectionId INT, CollectionLangId INT, CollectionName STRING, ChildClassId INT, "
                   "ChildClassLangId INT, ChildClassName STRING, PropertyId INT, PropertyEnumId INT, PropertyLangId INT, "
                   "PropertyName STRING, UnitId INT, UnitValue STRING, TimesliceId INT, TimesliceName STRING, ModelId INT, "
                   "ModelName STRING, SampleId INT, SampleName STRING",
    "membershipinfo": "MembershipId INT, ParentObjectCategoryName STRING, ParentObjectId INT, ParentObjectName STRING, ParentClassId INT, "
                      "ParentClassLangId INT, ParentClassName STRING, CollectionId INT, CollectionLangId INT, CollectionName STRING, "
                      "ChildObjectCategoryName STRING, ChildObjectId INT, ChildObjectName STRING, ChildClassId INT, "
                      "ChildClassLangId INT, ChildClassName STRING",
    "memoobject": "ColumnId INT, ObjectId INT, Value STRING",
    "object": "CategoryId INT, ClassId INT, Index INT, Name STRING, ObjectId INT, UniqueId STRING, Show BOOLEAN, X INT, Y INT, Z INT",
    "objectmeta": "Class STRING, ObjectId INT, Property STRING, Value STRING",
    "period": "PeriodEpochId BIGINT, EpochId BIGINT, PeriodId INT, StartDate TIMESTAMP, EndDate TIMESTAMP, PeriodTypeId INT, OriginalPeriodId INT",
    "phase": "Period_EpochId BIGINT, IntervalId INT, PeriodId INT, PhaseTypeId INT",
    "property": "CollectionId INT, EnumId INT, IsMultiBand BOOLEAN, IsPeriod BOOLEAN, IsSummary BOOLEAN, LangId INT, Name STRING, "
                "PropertyId INT, SummaryName STRING, SummaryUnitId INT, UnitId INT",
    "sampleweight": "PhaseId INT, SampleId INT, Value DOUBLE",
    "unit": "LangId INT, UnitId INT, Value STRING",
}

#: What tells the rows of a table apart, where its columns say so.
SOLUTION_KEYS = {
    "aggregatedseries": ("SeriesId",), "attribute": ("AttributeId",), "attributedata": ("AttributeId", "ObjectId"), "category": ("CategoryId",),
    "class": ("ClassId",), "classgroup": ("ClassGroupId",), "collection": ("CollectionId",), "data": ("dataFileId", "SeriesId", "PeriodId"),
    "fullkeyinfo": ("KeyId",), "membershipinfo": ("MembershipId",), "object": ("ObjectId",), "property": ("PropertyId",),
    "sampleweight": ("PhaseId", "SampleId"), "unit": ("UnitId",),
}

# ---------------------------------------------------------------------------
# Rule tables.
# ---------------------------------------------------------------------------
BLUEPRINT_STD = T.StructType([
    T.StructField("rule_ord", T.IntegerType(), False),
    T.StructField("Header", T.StringType()),
    T.StructField("Class", T.StringType()),
    T.StructField("Group", T.StringType()),
    T.StructField("Property", T.StringType()),
    T.StructField("Pattern", T.StringType()),
    T.StructField("Rate", T.BooleanType(), False),
    T.StructField("Unit", T.StringType()),
])

BLUEPRINT_RAT = T.StructType([
    T.StructField("rule_ord", T.IntegerType(), False),
    T.StructField("Class", T.StringType()),
    T.StructField("Group", T.StringType()),
    T.StructField("Property", T.StringType()),
    T.StructField("Alias", T.StringType()),
    T.StructField("Unit", T.StringType()),
])

GROUPS = T.StructType([
    T.StructField("Class", T.StringType()),
    T.StructField("Group", T.StringType()),
    T.StructField("Assets", T.StringType()),
])

UNIT_CONVERSION = T.StructType([
    T.StructField("UnitFrom", T.StringType()),
    T.StructField("UnitTo", T.StringType()),
    T.StructField("ConversionRate", T.DoubleType()),
])

NAME_MAP = T.StructType([
    T.StructField("map_ord", T.IntegerType(), False),
    T.StructField("source_name", T.StringType()),
    T.StructField("report_name", T.StringType()),
])
