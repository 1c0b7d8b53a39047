"""Pair constructors (c01-c14): joined rows, ordered predicates, numbered survivors, and counters of what each predicate dropped (a24)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.num import cosine
from ..functions.text import nonempty, picked
from ..registry import ORACLES, QUERIES, Inputs, oracle, query
from .relational import drop_reasons, first_wins, last_wins, negatives, numbered, ordered_part

@dataclass(frozen=True)
class Constructor:
    """name: pair type; source: input view; key: its ordinal; rules in order; reference and target columns; the sides whose scores describe them."""

    name: str
    source: str
    key: str
    rules: tuple[tuple[str, str], ...]
    reference: str
    target: str

    def judged(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("reason", drop_reasons(rows, list(self.rules)))

    def build(self, rows: DataFrame) -> DataFrame:
        """(pair_id, pair_type, the key, reference_audio, target_audio) of survivors, numbered in the order of the key."""
        kept = numbered(self.judged(rows).where("reason is null"), self.key, "seq")
        return kept.select(F.format_string(f"{self.name}_%06d", "seq").alias("pair_id"), F.lit(self.name).alias("pair_type"), self.key, F.col(self.reference).alias("reference_audio"), F.col(self.target).alias("target_audio"))

    def records(self, rows: DataFrame, instructions: tuple[str, ...], split: str = "", seed: str = "42") -> DataFrame:
        """The pair records of survivors: texts, an instruction of the pool (the same at every run; {ref_emotion}, {tgt_emotion} and {tgt_genre} stand for
        the sides' labels and the tag), the tag, the similarity, both sides' scores and where the row came from. Columns that rows lack are null."""
        kept = numbered(self.judged(rows).where("reason is null"), self.key, "seq")
        has = lambda name, kind="string": F.col(name) if name in kept.columns else F.lit(None).cast(kind)
        side = {"ref_audio": "r", "edited_audio": "e", "original_audio": "o"}
        text = {"ref_audio": "ref_text", "edited_audio": "ref_text", "original_audio": "original_text"}

        def scores(column: str) -> Column:
            s = side[column]
            return F.struct(has(f"{s}_top1").alias("top1_label"), has(f"{s}_prob", "double").alias("top1_prob"), has(f"{s}_neutral", "double").alias("P_neutral"), has(f"{s}_sv").alias("sv_label"))

        chosen = picked(instructions, seed, F.col(self.key))
        for hole, value in (("{ref_emotion}", has(f"{side[self.reference]}_top1")), ("{tgt_emotion}", has(f"{side[self.target]}_top1")), ("{tgt_genre}", has("edit_tag"))):
            if any(hole in i for i in instructions):
                chosen = F.replace(chosen, F.lit(hole), F.coalesce(value, F.lit("")))
        return kept.select(
            F.format_string(f"{split + '_' if split else ''}{self.name}_%06d", "seq").alias("pair_id"),
            F.lit(self.name).alias("pair_type"),
            F.col(self.reference).alias("reference_audio"),
            has(text[self.reference]).alias("reference_text"),
            F.col(self.target).alias("target_audio"),
            has(text[self.target]).alias("target_text"),
            chosen.alias("instruction"),
            has("edit_tag").alias("source_edit"),
            F.coalesce(has("speaker_similarity", "double"), has("sim", "double")).alias("speaker_similarity"),
            scores(self.reference).alias("ref_emotion"),
            scores(self.target).alias("tgt_emotion"),
            F.struct(F.lit(split).alias("split"), F.col(self.key).alias("source_row_index"), has("instruction").alias("editx_instruction")).alias("meta"),
        )

    def drops(self, rows: DataFrame) -> DataFrame:
        """How many rows each predicate dropped first, and how many survive (reason `kept`)."""
        return self.judged(rows).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))

    def oracle(self) -> str:
        keep = " AND ".join(f"coalesce({k}, false)" for _, k in self.rules)
        seq = f"row_number() OVER (ORDER BY {self.key}) - 1"
        return f"SELECT printf('{self.name}_%06d', {seq}) AS pair_id, '{self.name}' AS pair_type, {self.key}, {self.reference} AS reference_audio, {self.target} AS target_audio FROM {{{self.source}}} WHERE {keep}"

    def drops_oracle(self) -> str:
        cases = " ".join(f"WHEN NOT coalesce({k}, false) THEN '{r}'" for r, k in self.rules)
        return f"SELECT CASE {cases} ELSE 'kept' END AS reason, count(*) AS n FROM {{{self.source}}} GROUP BY 1"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(str(v)) for v in values)})"


def constructors(config: Mapping) -> dict[str, Constructor]:
    """The constructors of a configuration (sections as in config.ZH), by pair type.

    Their rules are over rows of base_scored, base_cosine, joined_scored or joined_cosine: sides e (edited), r (reference) and o (original) with _top1, _neutral
    and, where a second labeller is asked for, _sv; sim, edit_tag and cosines.
    """
    get = lambda name: config.get(name) or {}
    labels = get("emotion_filter").get("forbidden_top1_labels") or []

    def forbidden(*sides: str) -> list[tuple[str, str]]:
        return [("forbidden", "NOT (" + " OR ".join(f"coalesce({_in(f'{s}_top1', labels)}, false)" for s in sides) + ")")] if labels else []

    def similar(section: dict) -> list[tuple[str, str]]:
        return [("sim", f"coalesce(sim, 0) >= {section.get('sim_min', 0.0)}")]

    bc, mixed, h2 = get("bc"), get("c_mixed"), get("h2")
    edited = [("edit_not_neutral", f"e_neutral >= {bc.get('edited_neutral_min', 0.0)}")]
    edited += [("edit_top1", "e_top1 = 'neutral'")] if bc.get("edited_top1_must_be_neutral") else []
    edited += [("edit_sv", "e_sv = 'neutral'")] if bc.get("edited_sv_must_be_neutral") else []
    tag = [("tag", _in("edit_tag", bc.get("edit_whitelist", ())))]
    lively = [("ref_top1", "r_top1 IS NULL OR r_top1 <> 'neutral'")] if bc.get("ref_top1_not_neutral") else []
    b = [*tag, *forbidden("e", "r"), *edited, *lively, ("ref_neutral", f"r_neutral IS NULL OR r_neutral <= {bc.get('ref_neutral_max', 1.0)}")]
    original = [("org_missing", "o_neutral IS NOT NULL")]
    original += [("org_top1", "o_top1 <> 'neutral'")] if mixed.get("original_top1_not_neutral", True) else []
    original += [("org_neutral", f"o_neutral <= {mixed.get('original_neutral_max', bc.get('ref_neutral_max', 1.0))}")]

    def kept(section: dict, x: str, y: str) -> list[tuple[str, str]]:
        """The same emotion on both sides, shown."""
        out = [("same_top1", f"{x}_top1 = {y}_top1")] if section.get("same_top1_label") else []
        shown = [f"{s}_top1 <> 'neutral'" for s, k in ((x, "ref"), (y, "tgt")) if section.get(f"{k}_top1_not_neutral")]
        out += [("neutral", " AND ".join(shown))] if shown else []
        out += [("cosine", f"{x}{y}_cos >= {section['cosine_min']}")] if section.get("cosine_min") is not None else []
        return out + [("neutral_max", " AND ".join(f"({s}_neutral IS NULL OR {s}_neutral <= {section.get(f'{k}_neutral_max', 1.0)})" for s, k in ((x, "ref"), (y, "tgt"))))]

    def known(x: str, y: str) -> tuple[str, str]:
        return ("no_label", f"{x}_top1 IS NOT NULL AND {y}_top1 IS NOT NULL")

    cross = get("d_cross_emo")
    apart = [("same_top1", "r_top1 <> o_top1"), ("neutral_max", f"r_neutral <= {cross.get('ref_neutral_max', 1.0)} AND o_neutral <= {cross.get('tgt_neutral_max', 1.0)}")]
    h1 = get("h1")
    calm = [("tag", f"edit_tag = {str(h2.get('source_edit_tag', ''))!r}"), ("edit_not_neutral", f"e_neutral >= {h2.get('p_neutral_min', 0.0)}")]
    calm += [("edit_top1", "e_top1 = 'neutral'")] if h2.get("edited_top1_must_be_neutral") else []
    calm += [("edit_sv", "e_sv = 'neutral'")] if h2.get("require_sv_neutral") else []
    if h2.get("mode", "ref_to_edited") == "ref_to_edited":
        calm += [("ref_not_neutral", f"r_neutral >= {h2.get('ref_neutral_min', 0.0)}")]
        calm += [("ref_top1", "r_top1 = 'neutral'")] if h2.get("ref_top1_must_be_neutral") else []
        calm += [("not_more_neutral", f"e_neutral > r_neutral + {h2.get('target_more_neutral_margin', 0.0)}")] if h2.get("require_target_more_neutral", True) else []
    edit, base = ("joined_scored", "source_row_index"), ("base_scored", "original_idx")
    made = (
        Constructor("A", *base, tuple(similar(get("a"))), "original_audio", "ref_audio"),
        Constructor("B", *edit, tuple(b), "edited_audio", "ref_audio"),
        Constructor("C", *edit, tuple(b), "ref_audio", "edited_audio"),
        Constructor("C_mixed", *edit, (*tag, *forbidden("e", "o"), *edited, *original), "original_audio", "edited_audio"),
        Constructor("D", "base_cosine", "original_idx", (known("r", "o"), *forbidden("r", "o"), *kept(get("d"), "r", "o")), "ref_audio", "original_audio"),
        Constructor("D_st", "joined_cosine", "source_row_index", (*tag, known("r", "e"), *forbidden("r", "e"), *kept(get("d_st"), "r", "e")), "ref_audio", "edited_audio"),
        Constructor("D_cross_emo", *base, (known("r", "o"), *forbidden("r", "o"), *[x for x in kept(cross | {"same_top1_label": False, "cosine_min": None}, "r", "o") if x[0] == "neutral"], *apart), "ref_audio", "original_audio"),
        Constructor("Genre", *edit, (("tag", _in("edit_tag", get("genre").get("edit_tag_whitelist", ()))),), "ref_audio", "edited_audio"),
        Constructor("H1", "base_cosine", "original_idx", (*similar(h1), known("r", "o"), *([("same_top1", "r_top1 = o_top1")] if h1.get("same_top1_label") else []), ("cosine", f"ro_cos >= {h1.get('cosine_min', 0.0)}")), "original_audio", "ref_audio"),
        Constructor("H2", *edit, tuple(calm), "edited_audio" if h2.get("mode") in ("self", "neighbor") else "ref_audio", "edited_audio"),
    )
    return {c.name: c for c in made}


#: What the test tables' tags and scores call for: view is the neutral tag, click and purchase are genres.
_SHOWN = {"same_top1_label": True, "ref_top1_not_neutral": True, "tgt_top1_not_neutral": True, "ref_neutral_max": 0.95, "tgt_neutral_max": 0.95, "cosine_min": 0.7}
TABLES = {
    "emotion_filter": {"forbidden_top1_labels": ["unk"]},
    "a": {"sim_min": 0.5},
    "bc": {"edit_whitelist": ["view"], "edited_neutral_min": 0.12, "edited_top1_must_be_neutral": True, "ref_top1_not_neutral": True, "ref_neutral_max": 0.95},
    "c_mixed": {"original_top1_not_neutral": True},
    "d": _SHOWN,
    "d_st": _SHOWN,
    "d_cross_emo": {"ref_top1_not_neutral": True, "tgt_top1_not_neutral": True, "ref_neutral_max": 0.1, "tgt_neutral_max": 0.1},
    "genre": {"edit_tag_whitelist": ["click", "purchase"]},
    "h1": {"sim_min": 0.2, "cosine_min": 0.7, "same_top1_label": True},
    "h2": {"source_edit_tag": "view", "p_neutral_min": 0.12, "edited_top1_must_be_neutral": True, "ref_neutral_min": 0.05, "require_target_more_neutral": True},
}
CONSTRUCTORS = tuple(constructors(TABLES).values())


def neighbours(kept: DataFrame, key: str, same: str, seed: str) -> DataFrame:
    """Rows of a pool, each with at_<column> of another row of the pool (H2's third mode): of two rows drawn by a hash of the key the first whose `same`
    differs, else the first; the row itself if it is alone."""
    drawn = negatives(kept, key, seed, 2)
    w = [F.col(same) == F.col(f"at_{same}"), F.col("k")]
    best = first_wins(drawn.withColumn("_order", F.struct(w[0].alias("clash"), w[1].alias("k"))), [key], "_order")
    return best.drop("_order", "k")


def with_cosines(rows: DataFrame, pairs: tuple[tuple[str, str], ...]) -> DataFrame:
    for x, y in pairs:
        rows = rows.withColumn(f"{x}{y}_cos", cosine(F.col(f"{x}_v9"), F.col(f"{y}_v9")))
    return rows


def _rows(t: Inputs, source: str) -> DataFrame:
    if source == "base_cosine":
        return with_cosines(t["base_scored"], (("r", "o"),))
    if source == "joined_cosine":
        return with_cosines(t["joined_scored"], (("r", "e"),))
    return t[source]


_NUMBERS = {"A": 1, "B": 2, "C": 3, "C_mixed": 4, "D": 5, "D_st": 6, "D_cross_emo": 7, "Genre": 8, "H1": 10, "H2": 11}


def _register(c: Constructor) -> None:
    source = {"base_cosine": "(SELECT *, list_cosine_similarity(r_v9, o_v9) AS ro_cos FROM {base_scored})", "joined_cosine": "(SELECT *, list_cosine_similarity(r_v9, e_v9) AS re_cos FROM {joined_scored})"}.get(c.source, f"{{{c.source}}}")
    name = f"c{_NUMBERS[c.name]:02d}_pairs_{c.name}"
    QUERIES[name] = lambda spark, sf_dir: c.build(_rows(Inputs(spark, sf_dir), c.source))
    ORACLES[name] = oracle(c.oracle().replace(f"{{{c.source}}}", source))
    QUERIES[f"a24_drops_{c.name}"] = lambda spark, sf_dir: c.drops(_rows(Inputs(spark, sf_dir), c.source))
    ORACLES[f"a24_drops_{c.name}"] = oracle(c.drops_oracle().replace(f"{{{c.source}}}", source))


for _c in CONSTRUCTORS:
    _register(_c)


@query(
    "c09_pairs_Genre_conv",
    """WITH l AS (SELECT ref_audio, edit_tag, max(source_row_index) AS idx FROM {joined} GROUP BY ref_audio, edit_tag)
SELECT a.ref_audio, p.tag_a, p.tag_b, a.idx AS reference_idx, b.idx AS target_idx, printf('Genre_%06d', row_number() OVER (ORDER BY a.ref_audio, p.tag_a, p.tag_b) - 1) AS pair_id
FROM {tag_pair} p JOIN l a ON a.edit_tag = p.tag_a JOIN l b ON b.edit_tag = p.tag_b AND b.ref_audio = a.ref_audio""",
)
def c09(t: Inputs) -> DataFrame:
    last = t["joined"].groupBy("ref_audio", "edit_tag").agg(F.max("source_row_index").alias("idx"))
    a, b = (last.select("ref_audio", F.col("edit_tag").alias(f"tag_{s}"), F.col("idx").alias(f"{s}_idx")) for s in "ab")
    pairs = a.join(b, "ref_audio").join(F.broadcast(t["tag_pair"]), ["tag_a", "tag_b"])  # six allowed pairs of tags
    # numbered within parts of the references in order, and parts by what the ones before them hold
    pairs = pairs.withColumn("part", ordered_part(t["edit"], "ref_audio"))  # cut by the references of all edits, a plain scan
    before = pairs.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each part
    own = F.row_number().over(Window.partitionBy("part").orderBy("ref_audio", "tag_a", "tag_b")) - 1
    pairs = pairs.withColumn("own", own).join(F.broadcast(before), "part")
    return pairs.select("ref_audio", "tag_a", "tag_b", F.col("a_idx").alias("reference_idx"), F.col("b_idx").alias("target_idx"), F.format_string("Genre_%06d", F.col("before") + F.col("own")).alias("pair_id"))


@query(
    "c12_pairs_H3",
    """WITH a AS (SELECT original_idx, ref_audio, row_number() OVER (ORDER BY original_idx) - 1 AS r, count(*) OVER () AS n FROM {base} WHERE coalesce(sim, 0) >= 0.5),
k AS (SELECT a.*, k, (r + 1 + ('0x' || substr(md5(concat_ws(':', '42', original_idx::VARCHAR, k::VARCHAR)), 1, 8))::BIGINT % (n - 1)) % n AS at FROM a, (VALUES (0), (1)) x(k))
SELECT k.original_idx, k.k, k.ref_audio AS reference_audio, b.ref_audio AS target_audio, true AS is_negative FROM k JOIN a b ON b.r = k.at""",
)
def c12(t: Inputs) -> DataFrame:
    anchors = t["base"].where("coalesce(sim, 0) >= 0.5").select("original_idx", "ref_audio")
    out = negatives(anchors, "original_idx", "42", 2)
    return out.select("original_idx", "k", F.col("ref_audio").alias("reference_audio"), F.col("at_ref_audio").alias("target_audio"), F.lit(True).alias("is_negative"))


def transfer_pairs(jobs: DataFrame, results: DataFrame, name: str = "I", existing: DataFrame | None = None) -> DataFrame:
    """Pairs of a transfer run (c13): jobs whose last result is ok, in the order of source_row_index. jobs: job_id, source_row_index, prosody and timbre
    audios and texts, output_audio; results: job_id, ordinal, ok, audio. existing (path), if given, holds the audios that are there."""
    ok = last_wins(results, ["job_id"], "ordinal").where("ok").select("job_id", F.col("audio").alias("_audio"))
    rows = jobs.join(ok, "job_id").withColumn("target_audio", F.coalesce(nonempty(F.col("_audio")), F.col("output_audio"))).drop("_audio")
    if existing is not None:
        rows = rows.join(existing.select(F.col("path").alias("target_audio")).distinct(), "target_audio", "left_semi")
    rows = numbered(rows, "source_row_index", "seq")
    return rows.select(
        F.format_string(f"{name}_%06d", "seq").alias("pair_id"), F.lit(name).alias("pair_type"), "job_id", F.col("prosody_ref_audio").alias("reference_audio"), F.col("prosody_ref_text").alias("reference_text"),
        "prosody_ref_audio", "timbre_ref_audio", "target_audio", F.coalesce(nonempty(F.col("target_text")), F.col("prosody_ref_text")).alias("target_text"),
    )


def speed_pairs(report: DataFrame, kinds: Mapping[str, str], existing: DataFrame | None = None) -> DataFrame:
    """Pairs of speed edits (c14): report rows (source_row_index, edit_tag, audio1, text1, audio2, text2) whose tag has a pair type and that have a target
    audio. existing (path), if given, holds the audios that are there."""
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("edit_tag")]
    rows = report.withColumn("pair_type", kind).where(F.col("pair_type").isNotNull() & nonempty(F.col("audio2")).isNotNull())
    if existing is not None:
        rows = rows.join(existing.select(F.col("path").alias("audio2")).distinct(), "audio2", "left_semi")
    rows = numbered(rows, "source_row_index", "seq")
    return rows.select(
        F.concat("pair_type", F.format_string("_%06d", "seq")).alias("pair_id"), "pair_type", "source_row_index", F.col("audio1").alias("reference_audio"), F.col("text1").alias("reference_text"),
        F.col("audio2").alias("target_audio"), F.coalesce(nonempty(F.col("text2")), F.col("text1")).alias("target_text"), F.col("edit_tag").alias("source_edit"),
    )


@query(
    "c13_pairs_I",
    """WITH r AS (SELECT user_id, arg_max(event_type, event_id) AS st, max(event_id) AS target FROM {events} GROUP BY user_id),
k AS (SELECT c_custkey AS job_id, 'p/' || c_custkey AS reference_audio, 't/' || target AS target_audio, 'v/' || (c_custkey % 7) AS timbre_ref_audio FROM {customer} c JOIN r ON r.user_id = c.c_custkey WHERE r.st <> 'error' AND r.target IN (SELECT o_orderkey FROM {orders}))
SELECT printf('I_%06d', row_number() OVER (ORDER BY job_id) - 1) AS pair_id, * FROM k""",
)
def c13(t: Inputs) -> DataFrame:
    jobs = t["customer"].selectExpr("c_custkey as job_id", "c_custkey as source_row_index", "concat('p/', c_custkey) as prosody_ref_audio", "'x' as prosody_ref_text", "concat('v/', c_custkey % 7) as timbre_ref_audio", "'o' as output_audio", "'' as target_text")
    results = t["events"].selectExpr("user_id as job_id", "event_id as ordinal", "event_type <> 'error' as ok", "concat('t/', event_id) as audio")
    out = transfer_pairs(jobs, results, existing=t["orders"].selectExpr("concat('t/', o_orderkey) as path"))
    return out.select("pair_id", "job_id", "reference_audio", "target_audio", "timbre_ref_audio")


@query(
    "c14_pairs_J",
    """WITH k AS (SELECT event_id AS source_row_index, CASE event_type WHEN 'click' THEN 'J_fast' ELSE 'J_slow' END AS pair_type, 'a/' || user_id AS reference_audio, 'e/' || event_id AS target_audio FROM {events} WHERE event_type IN ('click', 'purchase') AND value > 1)
SELECT pair_type || printf('_%06d', row_number() OVER (ORDER BY source_row_index) - 1) AS pair_id, * FROM k""",
)
def c14(t: Inputs) -> DataFrame:
    report = t["events"].selectExpr("event_id as source_row_index", "event_type as edit_tag", "concat('a/', user_id) as audio1", "'x' as text1", "case when value > 1 then concat('e/', event_id) else '' end as audio2", "cast(null as string) as text2")
    return speed_pairs(report, {"click": "J_fast", "purchase": "J_slow"}).select("pair_id", "pair_type", "source_row_index", "reference_audio", "target_audio")


_H2_POOL = "e_neutral >= 0.12 AND e_top1 = 'neutral' AND edit_tag = 'view'"


@query("c11_pairs_H2_self", f"SELECT printf('H2_%06d', row_number() OVER (ORDER BY source_row_index) - 1) AS pair_id, 'H2' AS pair_type, source_row_index, edited_audio AS reference_audio, edited_audio AS target_audio FROM {{joined_scored}} WHERE {_H2_POOL}")
def c11_self(t: Inputs) -> DataFrame:
    return constructors(TABLES | {"h2": TABLES["h2"] | {"mode": "self"}})["H2"].build(t["joined_scored"])


@query(
    "c11_pairs_H2_neighbor",
    f"""WITH a AS (SELECT source_row_index, original_idx, edited_audio, row_number() OVER (ORDER BY source_row_index) - 1 AS r, count(*) OVER () AS n FROM {{joined_scored}} WHERE {_H2_POOL}),
k AS (SELECT a.*, k, (r + 1 + ('0x' || substr(md5(concat_ws(':', '42', source_row_index::VARCHAR, k::VARCHAR)), 1, 8))::BIGINT % greatest(n - 1, 1)) % n AS at FROM a, (VALUES (0), (1)) x(k))
SELECT k.source_row_index, k.edited_audio AS reference_audio, b.edited_audio AS target_audio FROM k JOIN a b ON b.r = k.at QUALIFY row_number() OVER (PARTITION BY k.source_row_index ORDER BY k.original_idx = b.original_idx, k.k) = 1""",
)
def c11_neighbor(t: Inputs) -> DataFrame:
    h2 = constructors(TABLES | {"h2": TABLES["h2"] | {"mode": "neighbor"}})["H2"]
    pool = h2.judged(t["joined_scored"]).where("reason is null").select("source_row_index", "original_idx", "edited_audio")
    return neighbours(pool, "source_row_index", "original_idx", "42").select("source_row_index", F.col("edited_audio").alias("reference_audio"), F.col("at_edited_audio").alias("target_audio"))


@query(
    "c02_records_B",
    """WITH k AS (SELECT * FROM {joined_scored} WHERE edit_tag = 'view' AND coalesce(e_top1, '') <> 'unk' AND coalesce(r_top1, '') <> 'unk' AND e_neutral >= 0.12 AND e_top1 = 'neutral' AND (r_top1 IS NULL OR r_top1 <> 'neutral') AND (r_neutral IS NULL OR r_neutral <= 0.95))
SELECT printf('s1_B_%06d', row_number() OVER (ORDER BY source_row_index) - 1) AS pair_id, edited_audio AS reference_audio, ref_audio AS target_audio,
  CASE WHEN ('0x' || substr(md5('7' || source_row_index::VARCHAR), 1, 8))::BIGINT % 2 = 0 THEN 'Louder' ELSE 'As ' || coalesce(r_top1, '') || ' as you can' END AS instruction,
  edit_tag AS source_edit, sim AS speaker_similarity, e_top1 AS ref_label, round(r_neutral, 6) AS tgt_neutral, source_row_index FROM k""",
)
def c02_records(t: Inputs) -> DataFrame:
    out = constructors(TABLES)["B"].records(t["joined_scored"], ("Louder", "As {tgt_emotion} as you can"), split="s1", seed="7")
    return out.select("pair_id", "reference_audio", "target_audio", "instruction", "source_edit", "speaker_similarity", F.col("ref_emotion.top1_label").alias("ref_label"), F.round("tgt_emotion.P_neutral", 6).alias("tgt_neutral"), "meta.source_row_index")
