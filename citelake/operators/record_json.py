"""Whole records as JSON for the two older table forms.

The document form takes a record's shape from the record: it is read as a Variant, whose objects and
lists follow what occurs, so nothing depends on a schema. The tree form has a list wherever the format
allows one, which only a schema can tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.functions.markup import (
    has_inline_markup,
    has_special_sections,
    without_inline_markup,
    without_special_sections,
)
from citelake.functions.numbers import tolerant_int
from citelake.functions.once import with_computed
from citelake.operators.extract_xml import MALFORMED, NOT_CLOSED
from citelake.schema import CITATION_TAG, DATA_TAG, LINEAGE_COLUMN, RECORD_TAG

# The element and attribute names of the record format. Elements that may hold
# inline markup (bold, sub- and superscript, formulas) are read with all their text.
MIXED_TAGS = (
    "ArticleTitle",
    "VernacularTitle",
    "AbstractText",
    "CopyrightInformation",
    "Affiliation",
    "CollectiveName",
    "LastName",
    "Suffix",
    "Keyword",
    "GeneralNote",
    "CoiStatement",
    "Citation",
    "Param",
)
_TEXT = "`#text`: string"
_ID = f"struct<`@Source`: string, {_TEXT}>"
_TERM = f"struct<`@UI`: string, `@MajorTopicYN`: string, `@Type`: string, {_TEXT}>"
_DATE = "struct<Year: string, Month: string, Day: string>"
_PERSON = f"""struct<`@ValidYN`: string, `@EqualContrib`: string, LastName: string,
  ForeName: string, Initials: string, Suffix: string, CollectiveName: string,
  Identifier: array<{_ID}>,
  AffiliationInfo: array<struct<Affiliation: string, Identifier: array<{_ID}>>>>"""
_ABSTRACT_PARTS = f"""AbstractText: array<struct<`@Label`: string, `@NlmCategory`: string,
  {_TEXT}>>, CopyrightInformation: string"""
_ARTICLE_IDS = f"ArticleIdList: struct<ArticleId: array<struct<`@IdType`: string, {_TEXT}>>>"
_REFERENCE = f"array<struct<Citation: string, {_ARTICLE_IDS}>>"

CITATION_FIELDS = f"""
  `@Owner`: string, `@Status`: string, `@VersionID`: string, `@VersionDate`: string,
  `@IndexingMethod`: string,
  PMID: struct<`@Version`: string, {_TEXT}>,
  DateCreated: {_DATE}, DateCompleted: {_DATE}, DateRevised: {_DATE},
  Article: struct<
    `@PubModel`: string,
    Journal: struct<
      ISSN: struct<`@IssnType`: string, {_TEXT}>,
      JournalIssue: struct<`@CitedMedium`: string, Volume: string, Issue: string,
        PubDate: struct<Year: string, Month: string, Day: string, Season: string,
          MedlineDate: string>>,
      Title: string, ISOAbbreviation: string>,
    ArticleTitle: struct<`@book`: string, `@part`: string, `@sec`: string, {_TEXT}>,
    Pagination: struct<StartPage: string, EndPage: string, MedlinePgn: string>,
    ELocationID: array<struct<`@EIdType`: string, `@ValidYN`: string, {_TEXT}>>,
    Abstract: struct<{_ABSTRACT_PARTS}>,
    AuthorList: struct<`@CompleteYN`: string, `@Type`: string, Author: array<{_PERSON}>>,
    Language: array<string>,
    DataBankList: struct<`@CompleteYN`: string, DataBank: array<struct<DataBankName: string,
      AccessionNumberList: struct<AccessionNumber: array<string>>>>>,
    GrantList: struct<`@CompleteYN`: string, Grant: array<struct<GrantID: string,
      Acronym: string, Agency: string, Country: string>>>,
    PublicationTypeList: struct<PublicationType: array<struct<`@UI`: string, {_TEXT}>>>,
    VernacularTitle: string,
    ArticleDate: array<struct<`@DateType`: string, Year: string, Month: string, Day: string>>>,
  MedlineJournalInfo: struct<Country: string, MedlineTA: string, NlmUniqueID: string,
    ISSNLinking: string>,
  ChemicalList: struct<Chemical: array<struct<RegistryNumber: string,
    NameOfSubstance: struct<`@UI`: string, {_TEXT}>>>>,
  SupplMeshList: struct<SupplMeshName: array<{_TERM}>>,
  CitationSubset: array<string>,
  CommentsCorrectionsList: struct<CommentsCorrections: array<struct<`@RefType`: string,
    RefSource: string, PMID: struct<`@Version`: string, {_TEXT}>, Note: string>>>,
  GeneSymbolList: struct<GeneSymbol: array<string>>,
  MeshHeadingList: struct<MeshHeading: array<struct<DescriptorName: {_TERM},
    QualifierName: array<{_TERM}>>>>,
  NumberOfReferences: string,
  PersonalNameSubjectList: struct<PersonalNameSubject: array<struct<LastName: string,
    ForeName: string, Initials: string, Suffix: string>>>,
  OtherID: array<{_ID}>,
  OtherAbstract: array<struct<`@Type`: string, `@Language`: string, {_ABSTRACT_PARTS}>>,
  KeywordList: array<struct<`@Owner`: string,
    Keyword: array<struct<`@MajorTopicYN`: string, {_TEXT}>>>>,
  CoiStatement: string,
  SpaceFlightMission: array<string>,
  InvestigatorList: struct<Investigator: array<{_PERSON}>>,
  GeneralNote: array<struct<`@Owner`: string, {_TEXT}>>
"""
DATA_FIELDS = f"""
  History: struct<PubMedPubDate: array<struct<`@PubStatus`: string, Year: string,
    Month: string, Day: string, Hour: string, Minute: string, Second: string>>>,
  PublicationStatus: string,
  {_ARTICLE_IDS},
  ObjectList: struct<Object: array<struct<`@Type`: string,
    Param: array<struct<`@Name`: string, {_TEXT}>>>>>,
  ReferenceList: array<struct<Title: string, Reference: {_REFERENCE},
    ReferenceList: array<struct<Title: string, Reference: {_REFERENCE}>>>>
"""
RECORD_SCHEMA = (
    f"{CITATION_TAG} struct<{CITATION_FIELDS}>, {DATA_TAG} struct<{DATA_FIELDS}>"
)

_MALFORMED_COLUMN = "_malformed"
_OPTIONS = {
    "attributePrefix": "@",
    "valueTag": "#text",
    "ignoreSurroundingSpaces": "true",
    "columnNameOfCorruptRecord": _MALFORMED_COLUMN,
}
# A Variant would make numbers of texts like "007". Each text is therefore read with a mark before it,
# which goes again. Where a record holds the mark, or its escape, they are spelled with the escape.
_MARK, _ESCAPE = "\ue000", "\ue001"
_BEFORE_TEXT = r"(>\s*+)(?=[^<\s])"
_BEFORE_VALUE = r"""(=\s*+["'])"""


def to_documents(records: DataFrame, schema: str | None = None) -> DataFrame:
    """``(PMID, JSON, src, raw, reason)``: attributes as ``@name``, text beside them as ``#text``.

    A tag that occurs once is a value and one that occurs more often a list, as the readers of
    this form expect; every element and attribute is kept at its path, whatever its name. An element
    without content is null. Only in elements that may hold inline markup (``MIXED_TAGS``) does the
    text stand without it; elsewhere the texts around child elements are listed. With ``schema``, the
    elements that it leaves out are left out.
    """
    flat, prepared = _prepared(records)
    text = F.regexp_replace(
        F.regexp_replace(_escaped(flat), _BEFORE_TEXT, F.lit(f"$1{_MARK}")),
        _BEFORE_VALUE,
        F.lit(f"$1{_MARK}"),
    )
    kind = "variant" if schema is None else f"struct<{schema}>"
    parsed = with_computed(
        prepared,
        _whole=F.from_xml(
            F.concat(F.lit("<r>"), text if schema is None else flat, F.lit("</r>")),
            f"{RECORD_TAG} {kind}, {_MALFORMED_COLUMN} string",
            _OPTIONS,
        ),
        _given=_broken_as_given(),
    )
    record = F.col("_whole")[RECORD_TAG]
    reason = _reason(F.col("_whole")[_MALFORMED_COLUMN])
    if schema is None:
        spelled = _unescaped(F.replace(F.to_json(record), F.lit(_MARK), F.lit("")))
        spelled = F.when(spelled.startswith("{"), spelled).otherwise(F.lit("{}"))
        identifier = _first_identifier(record)
    else:
        tree = parsed.schema["_whole"].dataType[RECORD_TAG].dataType
        spelled = F.coalesce(F.expr(_document(f"_whole.{RECORD_TAG}", tree)), F.lit("{}"))
        identifier = record[CITATION_TAG]["PMID"]["#text"]
    return parsed.select(
        F.when(reason.isNull(), F.coalesce(identifier, F.lit(""))).otherwise("").alias("PMID"),
        F.when(reason.isNull(), spelled).alias("JSON"),
        LINEAGE_COLUMN,
        F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
        reason.alias("reason"),
    )


def _first_identifier(record: Column) -> Column:
    """The text of the first ``PMID``, which may stand alone, beside attributes, or in a list."""
    found = [
        F.try_variant_get(record, f"$.{CITATION_TAG}{several}.PMID{nth}{text}", "string")
        for several in ("", "[0]")
        for nth in ("", "[0]")
        for text in ('["#text"]', "")
    ]
    # An object or list is no text; as a string it would begin with a bracket instead of the mark.
    marked = [F.when(x.startswith(_MARK), x) for x in found]
    return _unescaped(F.replace(F.coalesce(*marked), F.lit(_MARK), F.lit("")))


def _escaped(text: Column) -> Column:
    escaped = F.replace(
        F.replace(text, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}b")), F.lit(_MARK), F.lit(f"{_ESCAPE}a")
    )
    return F.when(text.rlike(f"[{_MARK}{_ESCAPE}]"), escaped).otherwise(text)


def _unescaped(text: Column) -> Column:
    plain = F.replace(
        F.replace(text, F.lit(f"{_ESCAPE}a"), F.lit(_MARK)), F.lit(f"{_ESCAPE}b"), F.lit(_ESCAPE)
    )
    return F.when(F.contains(text, F.lit(_ESCAPE)), plain).otherwise(text)


def to_trees(records: DataFrame, schema: str = RECORD_SCHEMA) -> DataFrame:
    """``(pmid, json, src, raw, reason)``: no attributes, and lists wherever the format has one.

    An element that the format allows once and that occurs more often becomes a list. A record with an
    element or attribute at a path that the schema does not name carries its XML as ``#raw`` besides, so
    that nothing is lost.
    """
    flat, prepared = _prepared(records)
    single = _parse_type(records.sparkSession, schema)
    parsed = with_computed(
        prepared.withColumn("_flat", flat),
        _record=F.from_xml(
            "_flat", _all_lists(single).add(_MALFORMED_COLUMN, T.StringType()), _OPTIONS
        ),
        _given=_broken_as_given(),
    )
    reason = _reason(F.col("_record")[_MALFORMED_COLUMN])
    tree = parsed.select(
        LINEAGE_COLUMN,
        F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
        reason.alias("reason"),
        F.when(reason.isNull(), F.col("_record")).alias("_record"),
        F.when(reason.isNull() & _unplaced(F.col("_flat"), single), F.col("raw")).alias("_raw"),
    )
    identifier = F.get(F.get(F.col("_record")[CITATION_TAG], F.lit(0))["PMID"], F.lit(0))["#text"]
    return tree.select(
        tolerant_int(F.get(identifier, F.lit(0))).alias("pmid"),
        F.when(F.col("reason").isNull(), _with_raw(F.expr(_tree("_record", single)))).alias("json"),
        LINEAGE_COLUMN,
        "raw",
        "reason",
    )


def _prepared(records: DataFrame) -> tuple[Column, DataFrame]:
    """A record's XML without inline markup where its text is wanted whole, and the rows it is of."""
    closed = F.col("closed") if "closed" in records.columns else F.lit(True)
    rewritten = without_inline_markup(without_special_sections(F.col("raw")), MIXED_TAGS, ())
    special = has_special_sections(F.col("raw")) | has_inline_markup(F.col("raw"), MIXED_TAGS)
    rows = with_computed(
        records.select(LINEAGE_COLUMN, "raw", closed.alias("_closed")),
        _changed=F.when(special, rewritten),
    )
    return F.coalesce("_changed", "raw"), rows


def _broken_as_given() -> Column:
    """What rewriting may have hidden: the record as it was, if that is malformed."""
    given = F.from_xml("raw", f"{_MALFORMED_COLUMN} string", _OPTIONS)[_MALFORMED_COLUMN]
    return F.when(F.col("_changed").isNotNull(), given)


def _reason(malformed: Column) -> Column:
    broken = F.coalesce(malformed, F.col("_given")).isNotNull()
    return F.when(~F.col("_closed"), NOT_CLOSED).when(broken, MALFORMED)


def _parse_type(spark, schema: str) -> T.StructType:
    return spark.createDataFrame([], schema).schema


def _all_lists(kind: T.DataType) -> T.DataType:
    """The type with a list wherever it has a single element."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_all_lists(kind.elementType))
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.dataType
                if f.name.startswith("@")
                else _all_lists(f.dataType)
                if isinstance(f.dataType, T.ArrayType)
                else T.ArrayType(_all_lists(f.dataType)),
            )
            for f in kind.fields
        ]
    )


def _paths(kind: T.DataType, path: str) -> list[str]:
    """The paths of all elements and attributes of a type."""
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, path)
    found = [path]
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            if f.name.startswith("@"):
                found.append(f"{path}/{f.name}")
            elif f.name != "#text":
                found += _paths(f.dataType, f"{path}/{f.name}")
    return found


_NAME = r"[A-Za-z_][\w.:-]*+"
_TOKEN = rf"""</?{_NAME}|\s{_NAME}\s*+=\s*+(?:"[^"]*+"|'[^']*+')|/?>"""


def _unplaced(flat: Column, kind: T.StructType) -> Column:
    """Whether an element or attribute stands at a path that the schema lacks.

    The tags of the record are gone through with the path so far; what looks like an attribute or the
    end of a tag in a text is passed over.
    """
    known = F.lit(" " + " ".join(_paths(kind, f"/{RECORD_TAG}")) + " ")
    start = F.struct(F.lit("").alias("path"), F.lit(False).alias("inside"), F.lit(False).alias("odd"))

    def lacks(path: Column) -> Column:
        return ~F.contains(known, F.concat(F.lit(" "), path, F.lit(" ")))

    def after(path: Column, inside: Column, odd: Column) -> Column:
        return F.struct(path.alias("path"), inside.alias("inside"), odd.alias("odd"))

    def parent(path: Column) -> Column:
        last = F.substring_index(path, "/", -1)
        return F.substr(path, F.lit(1), F.length(path) - F.length(last) - 1)

    def step(state: Column, token: Column) -> Column:
        path, odd = state["path"], state["odd"]
        deeper = F.concat(path, F.lit("/"), F.substr(token, F.lit(2)))
        name = F.trim(F.translate(F.substring_index(token, "=", 1), "\t\r\n", "   "))
        return (
            F.when(token.startswith("</"), after(parent(path), F.lit(False), odd))
            .when(token.startswith("<"), after(deeper, F.lit(True), odd | lacks(deeper)))
            .when(~state["inside"], state)
            .when(token == "/>", after(parent(path), F.lit(False), odd))
            .when(token == ">", after(path, F.lit(False), odd))
            .otherwise(after(path, F.lit(True), odd | lacks(F.concat(path, F.lit("/@"), name))))
        )

    tokens = F.regexp_extract_all(flat, F.lit(_TOKEN), F.lit(0))
    return F.coalesce(F.aggregate(tokens, start, step)["odd"], F.lit(False))


def _with_raw(spelled: Column) -> Column:
    """Put ``#raw`` behind the other keys of an object."""
    text = F.to_json(F.array("_raw"))
    text = F.substr(text, F.lit(2), F.length(text) - 2)
    start = F.substr(spelled, F.lit(1), F.length(spelled) - 1)
    comma = F.when(spelled == "{}", "").otherwise(",")
    return F.when(F.col("_raw").isNull(), spelled).otherwise(
        F.concat(start, comma, F.lit('"#raw":'), text, F.lit("}"))
    )


# The spelling of a tree follows its schema and is long, so it is put together as SQL text.


def _quoted(text: str) -> str:
    # Inside the brackets stands a quoted text, so trimming stops at its quotes.
    return f"btrim(to_json(array({text})), '[]')"


def _spelled_object(value: str, kind: T.StructType, names: list[str], spell, depth: int) -> str:
    entries = [
        f"CASE WHEN {value}.`{name}` IS NOT NULL THEN "
        f"concat('\"{name}\":', {spell(f'{value}.`{name}`', kind[name].dataType, depth)}) END"
        for name in names
    ]
    return f"concat('{{', array_join(array({', '.join(entries)}), ','), '}}')"


def _spelled_items(value: str, kind: T.ArrayType, spell, missing: str, depth: int) -> str:
    item = f"item{depth}"
    spelled = spell(item, kind.elementType, depth + 1)
    return f"array_join(transform({value}, {item} -> coalesce({spelled}, '{missing}')), ',')"


def _document(value: str, kind: T.DataType, depth: int = 0) -> str:
    if isinstance(kind, T.StructType):
        names = kind.fieldNames()
        spelled = _spelled_object(value, kind, names, _document, depth)
        if "#text" not in names:
            return spelled
        # Text without attributes stands for the element.
        attributes = ", ".join(["NULL", *(f"{value}.`{name}`" for name in names if name != "#text")])
        alone = _document(f"{value}.`#text`", T.StringType(), depth)
        return f"CASE WHEN coalesce({attributes}) IS NOT NULL THEN {spelled} ELSE {alone} END"
    if isinstance(kind, T.ArrayType):
        items = _spelled_items(value, kind, _document, "null", depth)
        several = f"size({value}) > 1"
        return f"concat(if({several}, '[', ''), {items}, if({several}, ']', ''))"
    return f"CASE WHEN {value} <> '' THEN {_quoted(value)} ELSE 'null' END"


def _tree(value: str, kind: T.DataType, depth: int = 0) -> str:
    """``kind`` says where lists belong; in ``value`` every element is a list."""
    if isinstance(kind, T.StructType):
        names = [name for name in kind.fieldNames() if not name.startswith("@")]
        if names == ["#text"]:
            return _quoted(f"coalesce(array_join({value}.`#text`, ''), '')")
        if len(names) == 1 and isinstance(kind[names[0]].dataType, T.ArrayType):
            members = _tree(f"{value}.`{names[0]}`", kind[names[0]].dataType, depth)
            return f"coalesce({members}, '[]')"
        return _spelled_object(value, kind, names, _tree_element, depth)
    if isinstance(kind, T.ArrayType):
        return f"""concat('[', {_spelled_items(value, kind, _tree, '""', depth)}, ']')"""
    return _quoted(f"coalesce({value}, '')")


def _tree_element(value: str, kind: T.DataType, depth: int) -> str:
    """A single element as what it holds, a repeated one as a list."""
    if isinstance(kind, T.ArrayType):
        return _tree(value, kind, depth)
    items = _spelled_items(value, T.ArrayType(kind), _tree, '""', depth)
    return f"concat(if(size({value}) > 1, '[', ''), {items}, if(size({value}) > 1, ']', ''))"
