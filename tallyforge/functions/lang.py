"""Language of a posting by word patterns, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.rules import quote

#: Texts shorter than this say nothing.
LEAST_CHARS = 10
THRESHOLD = 0.8

# Patterns that speak for English, and for other languages in the order in which they are asked.
ENGLISH = (
    r"\b(?:job|position|role|career|opportunity|hiring|employment)\b",
    r"\b(?:responsibilities|requirements|qualifications|experience)\b",
    r"\b(?:skills|education|benefits|salary|location|remote)\b",
    r"\b(?:full-time|part-time|contract|permanent|temporary)\b",
    r"\b(?:company|team|department|manager|employee|candidate)\b",
    r"\b(?:apply|submit|send|email|contact|interview)\b",
    r"\b(?:the|and|or|but|in|on|at|to|for|with|by|from|of|as)\b",
    r"\b(?:is|are|was|were|will|would|should|could|must|may|can)\b",
)
LATIN = {
    "es": (
        r"\b(?:trabajo|empleo|puesto|oportunidad|empresa|requisitos)\b",
        r"\b(?:experiencia|habilidades|educación|salario|ubicación)\b",
        r"\b(?:tiempo completo|medio tiempo|contrato|permanente)\b",
    ),
    "fr": (
        r"\b(?:emploi|poste|opportunité|entreprise|exigences|compétences)\b",
        r"\b(?:expérience|éducation|salaire|lieu|temps plein|temps partiel)\b",
    ),
    "de": (
        r"\b(?:arbeit|stelle|position|unternehmen|anforderungen|fähigkeiten)\b",
        r"\b(?:erfahrung|bildung|gehalt|standort|vollzeit|teilzeit)\b",
    ),
    "pt": (
        r"\b(?:trabalho|emprego|posição|oportunidade|empresa|requisitos)\b",
        r"\b(?:experiência|habilidades|educação|salário|localização)\b",
    ),
    "it": (
        r"\b(?:lavoro|impiego|posizione|opportunità|azienda|requisiti)\b",
        r"\b(?:esperienza|competenze|educazione|stipendio|posizione)\b",
    ),
}
EAST_ASIAN = {
    "ko": (
        "채용|구인|모집|입사|취업|일자리|직장|직무|업무", "경력|경험|학력|기술|능력|자격|요건|조건", "회사|기업|팀|부서|직원|인재|지원자",
        "급여|연봉|임금|복리후생|근무|정규직|계약직|파트타임", "서류전형|면접|지원|접수|마감|문의",
        "쿠팡|개발자|컨설턴트|매니저|엔지니어|디자이너", "광고|마케팅|영업|기획|운영|분석", "백엔드|프론트엔드|풀스택|데이터|시스템",
        "시니어|주니어|신입|경력|전환|가능", "년|이상|미만|우대|필수|우선", "관리|담당|책임|업무|역할|포지션",
        "팀장|부장|과장|대리|주임|사원|실장", "전문가|스페셜리스트|어드바이저|코디네이터", "풀타임|정규직|비정규직|계약직|인턴|신입",
        "근무지|위치|지역|본사|지점|사무실",
    ),
    "zh": (
        "招聘|求职|工作|职位|岗位|就业|入职", "经验|学历|技能|能力|资格|要求|条件", "公司|企业|团队|部门|员工|人才|候选人",
        "薪资|工资|待遇|福利|工作|全职|兼职|合同", "简历|面试|申请|投递|截止|咨询",
    ),
    "ja": (
        "採用|求人|募集|入社|就職|仕事|職場|職種|業務", "経験|学歴|技術|能力|資格|要件|条件", "会社|企業|チーム|部署|社員|人材|応募者",
        "給与|年収|賃金|福利厚生|勤務|正社員|契約社員|パートタイム", "書類選考|面接|応募|受付|締切|問合せ",
    ),
}
CODES = {"zh-cn": "zh", "zh-tw": "zh", "zh-hans": "zh", "zh-hant": "zh", "en-us": "en", "en-gb": "en", "ja-jp": "ja", "ko-kr": "ko"}


LANGUAGES = ("en", *LATIN, *EAST_ASIAN)
EAST_ASIAN_TEXT = "[\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7a3]"
_WORDS = r"\b(?:"


def _merged(patterns: tuple[str, ...]) -> tuple[str, ...]:
    """One pattern for several lists of words that share none, so that a text is read once."""
    words = [w for p in patterns if p.startswith(_WORDS) for w in p[len(_WORDS) : -len(r")\b")].split("|")]
    if len(words) != len(set(words)) or not all(p.startswith(_WORDS) for p in patterns):
        return patterns
    return (_WORDS + "|".join(words) + r")\b",)


def _hits(text: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit(f"(?i){p}")) for p in _merged(patterns)])


#: For the oracle, whose word boundaries know ASCII only: letters beyond it, written with word characters of it.
_SPELT = {c: f"q{ord(c):x}q" for c in sorted({c for p in (*ENGLISH, *(x for g in LATIN.values() for x in g)) for c in p if ord(c) > 127})}
_OTHER_LETTERS = "[\\x{00aa}\\x{00b5}\\x{00ba}\\x{00c0}-\\x{00d6}\\x{00d8}-\\x{00f6}\\x{00f8}-\\x{02af}\\x{0370}-\\x{1fff}\\x{3041}-\\x{318e}\\x{3400}-\\x{9fff}\\x{ac00}-\\x{d7a3}]"


def _hits_sql(e: str, patterns: tuple[str, ...], east: bool) -> str:
    if not east:
        patterns = tuple("".join(_SPELT.get(c, c) for c in p) for p in patterns)
    return "(" + " + ".join(f"len(regexp_extract_all({e}, {quote('(?i)' + p)}))" for p in patterns) + ")"


def pattern_hits(text: Column) -> Column:
    """Pattern hits of English and of each language, an array in the order of LANGUAGES.

    It should be a column of its own before language_of() is applied: an array isn't
    taken apart by the optimizer, so that each pattern runs once.
    """
    t = F.coalesce(text, F.lit(""))
    east = t.rlike(EAST_ASIAN_TEXT)
    groups = {"en": ENGLISH} | LATIN | EAST_ASIAN
    return F.array(*[F.when(east, _hits(t, p)).otherwise(0) if lang in EAST_ASIAN else _hits(t, p) for lang, p in groups.items()])


def pattern_hits_sql(e: str) -> dict[str, str]:
    east = f"coalesce({e}, '')"
    plain = reduce(lambda x, kv: f"replace(replace({x}, {quote(kv[0])}, {quote(kv[1])}), {quote(kv[0].upper())}, {quote(kv[1])})", _SPELT.items(), east)
    plain = f"regexp_replace({plain}, {quote(_OTHER_LETTERS)}, 'qzq', 'g')"
    return {lang: _hits_sql(east if lang in EAST_ASIAN else plain, p, lang in EAST_ASIAN) for lang, p in ({"en": ENGLISH} | LATIN | EAST_ASIAN).items()}


def language_of(text: Column, hits: Column) -> Column:
    """struct(lang, confidence) from a text and its pattern_hits (a column, so that they are counted once).

    One East Asian hit decides; a Latin language needs two; otherwise the share of English
    hits tells. Null and short texts are 'unknown' with confidence 0.
    """
    all_hits, hits = hits, {}
    for i, lang in enumerate(LANGUAGES):
        hits[lang] = F.get(all_hits, F.lit(i))
    conf = lambda most, base, step, n: F.least(F.lit(most), F.lit(base) + F.lit(step) * n)
    answer = lambda lang, c: F.struct(F.lit(lang).alias("lang"), c.cast("double").alias("confidence"))
    others = reduce(lambda a, b: a + b, [hits[x] for x in (*LATIN, *EAST_ASIAN)])
    share = F.when(hits["en"] + others == 0, 0.5).otherwise(F.try_divide(hits["en"], hits["en"] + others))
    best = F.greatest(*[hits[x] for x in LATIN])
    cases = [F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < LEAST_CHARS, answer("unknown", F.lit(0.0)))]
    cases += [F.when(hits[x] >= 1, answer(x, conf(0.95, 0.8, 0.05, hits[x]))) for x in EAST_ASIAN]
    cases += [F.when((best >= 2) & (hits[x] == best), answer(x, conf(0.9, 0.6, 0.1, best))) for x in LATIN]
    cases += [F.when(share <= 0.3, answer("unknown", F.lit(0.3))), answer("en", share)]
    return F.coalesce(*cases)


def combined(primary: Column, fallback: Column, threshold: float = THRESHOLD) -> Column:
    """Of a statistical detector's answer (primary) and the patterns' (fallback) the one to take, with the method.

    Patterns decide for East Asian languages if they are sure; otherwise the primary
    answer if it is sure, else the fallback's if that is, else the surer one.
    """
    named = lambda x, how: F.struct(x["lang"].alias("lang"), x["confidence"].alias("confidence"), F.lit(how).alias("method"))
    p, f = primary["confidence"], fallback["confidence"]
    east = fallback["lang"].isin(*EAST_ASIAN) & (f >= 0.8)
    return F.when(east, named(fallback, "fallback")).when(p >= threshold, named(primary, "primary")).when(f >= threshold, named(fallback, "fallback")).when(p >= f, named(primary, "primary_unsure")).otherwise(named(fallback, "fallback_unsure"))


def of_fields(title: Column, body: Column, both: Column, threshold: float = THRESHOLD) -> Column:
    """The answer of several fields: struct(lang, confidence, source, is_english).

    The body's, unless only the title's is sure, or both are and the title's is an East
    Asian one. If neither is sure, that of title and body together; else the surer one.
    """
    sure = lambda x: x["confidence"] >= threshold
    say = lambda x, src: F.struct(x["lang"].alias("lang"), x["confidence"].alias("confidence"), F.lit(src).alias("source"), ((x["lang"] == "en") & sure(x)).alias("is_english"))
    east = title["lang"].isin(*EAST_ASIAN) & (title["lang"] != body["lang"])
    return (
        F.when(sure(title) & (~sure(body) | east), say(title, "job_title")).when(sure(body), say(body, "job_description"))
        .when(sure(both), say(both, "combined")).when(title["confidence"] > body["confidence"], say(title, "job_title_fallback"))
        .otherwise(say(body, "job_description_fallback"))
    )


def language_code(c: Column) -> Column:
    """A two-letter code; null and empty are 'unknown'."""
    low = F.lower(c)
    known = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.when(c.isNull() | (c == ""), "unknown").otherwise(F.coalesce(F.element_at(known, low), F.substring(low, 1, 2)))
