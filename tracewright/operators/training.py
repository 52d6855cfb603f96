"""Training rows: reasoning, answers, flags, hard examples, external rows and their budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import extract_json, json_span, pretty_json, strip_fences
from ..functions.textnorm import strip
from .ordering import in_order

# Flags and tags.
THINK_FLAG, NO_THINK_FLAG, THINK_TAG, ANSWER_TAG = "/think", "/no_think", "think", "answer"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
THINK_BLOCK = r"(?s)<think(?:ing)?>.*?</think(?:ing)?>(?U:\s*)"
MODES = ("thinking", "raw", "json")


def wrap(tag: str, c: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))


def human_text(messages: Column, conversations: Column) -> Column:
    """The first message's content, a list's text parts by lines, else the first turn's value.

    Lists are JSON text here, as content may be either.
    """
    content = F.element_at(messages, 1)["content"]
    parts = F.from_json(content, "array<struct<text: string>>", {"mode": "PERMISSIVE"})
    listed = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
    said = F.coalesce(F.try_element_at(conversations, F.lit(1))["value"], F.lit(""))
    is_list = content.startswith("[{") & parts.isNotNull()
    return F.when(F.coalesce(F.size(messages), F.lit(0)) > 0, F.coalesce(F.when(is_list, listed).otherwise(content), F.lit(""))).otherwise(said)


def filled(c: Column) -> Column:
    """Stripped text; null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def reply_without_json(reply: Column) -> Column:
    """What a reply says around its first object, without fences; all of it if it has none."""
    span = json_span(reply)
    around = F.concat(F.substring(reply, F.lit(1), span["start"]), F.substring(reply, span["stop"] + 1, F.char_length(reply)))
    return F.when(span["start"].isNull(), strip(reply)).otherwise(strip(strip_fences(around)))


def reasoning_text(polished: Column, reasoning: Column, reply: Column) -> Column:
    """A rewritten chain, else the reasoning channel, else the reply without its answer."""
    return F.coalesce(filled(polished), filled(reasoning), reply_without_json(reply), F.lit(""))


def reasoning_channel(response: Column) -> Column:
    return F.get_json_object(response, "$.choices[0].message.reasoning_content")


def with_flag(text: Column, flag: str, known: tuple[str, ...] = (THINK_FLAG, NO_THINK_FLAG)) -> Column:
    """The text with the flag as its last line and no other flag line; an empty flag removes none."""
    lines = F.split(text, LINE_END)
    closed = F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    if not flag:
        return F.array_join(closed, "\n")
    kept = F.filter(closed, lambda x: ~strip(x).isin(*known))
    return F.array_join(F.concat(kept, F.array(F.lit(flag))), "\n")


def with_image_mark(text: Column, images: Column) -> Column:
    return F.when((F.coalesce(F.size(images), F.lit(0)) > 0) & ~text.contains("<image>"), F.concat(F.lit("<image>\n"), text)).otherwise(text)


def answer_text(predicted: Column, tag: str = ANSWER_TAG) -> Column:
    """A JSON object, pretty, in its tag; null without one."""
    return wrap(tag, pretty_json(predicted))


def training_rows(records: DataFrame, mode: str = "thinking", *, fences: bool = False, think_flag: str = THINK_FLAG, no_think_flag: str = NO_THINK_FLAG, think_tag: str = THINK_TAG, answer_tag: str = ANSWER_TAG) -> DataFrame:
    """(sample_id, _ord, human, gpt, images) of records with what their mode needs.

    Records have human, images, reply, reasoning, polished_cot, polished_answer (both null unless
    applied) and predicted_json.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    known = (think_flag, no_think_flag, THINK_FLAG, NO_THINK_FLAG)
    if mode == "raw":
        gpt = F.nullif(F.col("reply"), F.lit(""))
        made = records.withColumn("gpt", strip_fences(gpt) if fences else gpt).withColumn("_thinks", F.lit(True))
    else:
        answer = F.coalesce("polished_answer", "predicted_json")
        made = records.withColumn("_answer", answer_text(answer, answer_tag))
        cot = reasoning_text(F.col("polished_cot"), F.col("reasoning"), F.col("reply")) if mode == "thinking" else F.lit("")
        made = made.withColumn("_cot", cot).withColumn("_thinks", F.col("_cot") != "")
        made = made.withColumn("gpt", F.when(F.col("_thinks"), F.concat(wrap(think_tag, F.col("_cot")), F.lit("\n"), F.col("_answer"))).otherwise(F.col("_answer")))
    text = with_image_mark(F.col("human"), F.col("images"))
    human = F.when(F.col("_thinks"), with_flag(text, think_flag, known)).otherwise(with_flag(text, no_think_flag, known))
    return made.filter("gpt is not null").select("sample_id", "_ord", human.alias("human"), "gpt", "images")


def failed_eligible(source: str) -> Column:
    """Failed records that may become hard examples, by how far their ground truth is trusted."""
    if source == "upheld":
        return F.coalesce(~F.col("judge_result.overturned") & F.col("judge_result.failure").isNull(), F.lit(False))
    if source == "mismatch":
        return F.coalesce(F.size("differences") > 0, F.lit(False))
    return F.lit(True)


def as_chat(rows: DataFrame, *more: str) -> DataFrame:
    """(sample_id, _ord, conversations, images, ...) of training rows: two turns each."""
    turn = lambda who, c: F.struct(F.lit(who).alias("from"), F.col(c).alias("value"))
    return rows.select("sample_id", "_ord", F.array(turn("human", "human"), turn("gpt", "gpt")).alias("conversations"), "images", *more)


def hard_examples(failed: DataFrame, source: str = "all", *, think_flag: str = THINK_FLAG, no_think_flag: str = NO_THINK_FLAG, answer_tag: str = ANSWER_TAG) -> DataFrame:
    """(sample_id, _ord, human, gpt, images, recovered): the ground truth as answer, nothing of
    the failed reply. Ground truth that the record lacks is taken from the sample's text."""
    truth = failed.filter(failed_eligible(source)).withColumn("_gt", F.coalesce("ground_truth", extract_json(F.col("ground_truth_text"))))
    rows = truth.withColumn("gpt", answer_text(F.col("_gt"), answer_tag)).filter("gpt is not null")
    human = with_flag(with_image_mark(F.col("human"), F.col("images")), no_think_flag, (think_flag, no_think_flag, THINK_FLAG, NO_THINK_FLAG))
    return rows.select("sample_id", "_ord", human.alias("human"), "gpt", "images", F.col("ground_truth").isNull().alias("recovered"))


def sanitized_turn(speaker: Column, value: Column, *, think_flag: str = THINK_FLAG, no_think_flag: str = NO_THINK_FLAG, answer_tag: str = ANSWER_TAG) -> Column:
    """An external turn without reasoning: answers re-wrapped, questions flagged, others as they are."""
    bare = strip(F.regexp_replace(value, THINK_BLOCK, ""))
    a, z = f"<{answer_tag}>", f"</{answer_tag}>"
    inside = F.when(bare.startswith(a) & bare.endswith(z), strip(F.substring(bare, F.lit(len(a) + 1), F.char_length(bare) - len(a) - len(z)))).otherwise(bare)
    answer = F.when(inside == "", value).otherwise(wrap(answer_tag, inside))
    return F.when(value.isNull(), value).when(speaker == "gpt", answer).when(speaker == "human", with_flag(value, no_think_flag, (think_flag, no_think_flag, THINK_FLAG, NO_THINK_FLAG))).otherwise(value)


def sanitized(rows: DataFrame, **names: str) -> DataFrame:
    """External rows with all turns of `conversations` sanitised; flags and tags by name."""
    turn = lambda t: F.struct(t["from"].alias("from"), sanitized_turn(t["from"], t["value"], **names).alias("value"))
    return rows.withColumn("conversations", F.transform("conversations", turn))


#: Picked rows that may meet in one task, which then keeps the first ones of each partition alone.
FEW = 10_000


def seeded_pick(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The n rows whose seeded digests come first; the same ones each time. Many are told by
    their places in a sort, so they never meet in one task."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    if n <= FEW:
        return rows.orderBy(digest, key).limit(n)
    return in_order(rows.withColumn("_digest", digest), [], ["_digest", key]).filter(F.col("_place") < n).drop("_digest", "_part", "_place")


def no_cot_budget(converted: int, ratio: float) -> int:
    return int(ratio * converted)


def assembled(converted: DataFrame, failed: DataFrame, external: DataFrame, ratio: float, key: str = "sample_id") -> DataFrame:
    """Converted rows, then failed ones within the budget, then external ones that fill it.

    `_block` and `_ord` give the order. Two counts come to the driver, nothing else.
    """
    budget = no_cot_budget(converted.count(), ratio)
    n = failed.count() if budget else 0
    used = min(budget, n)
    block = lambda df, b: df.withColumn("_block", F.lit(b))
    chosen = failed if used == n else seeded_pick(failed, used, key)
    out = block(converted, 0)
    if used:
        out = out.unionByName(block(chosen, 1), allowMissingColumns=True)
    if budget > used:
        out = out.unionByName(block(seeded_pick(external, budget - used, key), 2), allowMissingColumns=True)
    return out


def convert_summary(rows: DataFrame, *, total_records: int | None = None, ratio: float | None = None) -> DataFrame:
    """One row; converted + failed_used + mixed_in = total_samples.

    With the number of records that were read, it tells how many lacked what their mode needs;
    with the ratio, the budget. `recovered` counts hard examples whose ground truth came from
    the sample's text.
    """
    count = lambda b: F.count_if(F.col("_block") == b)
    found = F.count_if(F.col("recovered")) if "recovered" in rows.columns else F.lit(0).cast("long")
    out = rows.agg(count(0).alias("converted"), count(1).alias("failed_used"), count(2).alias("mixed_in"), F.count("*").alias("total_samples"), found.alias("failed_gt_recovered"))
    if total_records is not None:
        out = out.withColumn("total_records", F.lit(total_records).cast("long")).withColumn("skipped", F.col("total_records") - F.col("converted"))
    if ratio is not None:
        out = out.withColumn("no_cot_budget", F.floor(F.lit(ratio) * F.col("converted")))
    return out
