"""JSON in answers of language models: as it is, fenced, or somewhere between prose."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECTIONS = ("salary_info", "experience_requirements", "skills", "work_arrangement", "job_classification")


def _objects_in(text: str):
    """The JSON objects that begin at a brace of the text, one after another.

    A brace at which no object parses is left, and the search goes on where its parsing
    failed, so a stray brace hides nothing behind it, a broken object isn't replaced by one
    of its parts, and the whole takes one pass.
    """
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            got, after = decoder.raw_decode(text, at)
            yield got
        except json.JSONDecodeError as e:
            after = max(e.pos, at + 1)
        except RecursionError:  # nested deeper than the decoder goes: no answer to be read
            return
        at = text.find("{", after)


def salvage(text: str | None) -> str | None:
    """The JSON object of an answer as compact text, None if there is none.

    What is fenced goes before prose. An answer that is a list has none; an empty object
    counts only if it is the whole answer.
    """
    bare = (text or "").strip()
    if bare == "{}":
        return bare
    if bare.startswith("["):
        return None
    found = next((got for part in (*bare.split("```")[1::2], bare) for got in _objects_in(part) if got), None)
    return None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":"))


@F.pandas_udf(T.StringType())
def salvaged_json(s: pd.Series) -> pd.Series:
    """salvage() in Arrow batches; finding where an object begins is the one thing here that needs Python."""
    return s.map(salvage)


SECTION_SCHEMA = "struct<confidence:double>"


def mean_confidence(js: Column) -> Column:
    """Mean of the sections' confidences that lie between 0 and 1; 0 without any."""
    got = F.filter(F.array(*[F.get_json_object(js, f"$.{s}.confidence").try_cast("double") for s in SECTIONS]), lambda x: x.between(0, 1))
    return F.coalesce(F.try_divide(F.aggregate(got, F.lit(0.0), lambda a, x: a + x), F.size(got)), F.lit(0.0))


def missing_sections(js: Column) -> Column:
    """Names of the required sections that an answer lacks."""
    return F.filter(F.array(*[F.when(F.get_json_object(js, f"$.{s}").isNull(), F.lit(s)) for s in SECTIONS]), lambda x: x.isNotNull())
