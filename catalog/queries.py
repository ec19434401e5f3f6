"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracecurate.config import CurationConfig
from tracecurate.functions import text as T
from tracecurate.functions.prompts import render_template
from tracecurate.operators import (
    assembly,
    compare,
    completions,
    explore,
    histories,
    increments,
    ingest,
    report,
    scoring,
    seeding,
    sessions,
    splits,
    synthesis,
)
from tracecurate.plans import jobs
from tracecurate.schema import TRAINING
from tracecurate.sources import tables
from tracecurate.sources.staging import materialize, new_stage_path

from . import stubs
from .adapter import prompts, table, traces

CONFIG = CurationConfig(copies=3)
# The same with limits that send every session down the paths for long ones.
LONG = CurationConfig(copies=3, hot_session_turns=1, long_history_turns=1, history_block_turns=2)
RUN_ID, SYSTEM = "run-1", "Answer in full."

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- stages shared by the queries below; each call builds them anew ----


def normalized(spark, sf_dir):
    return ingest.normalize_traces(traces(spark, sf_dir), CONFIG)


def turns(spark, sf_dir):
    return ingest.clean_turns(traces(spark, sf_dir), CONFIG)


def with_session(found):
    return found.withColumn("session_id", ingest.session_id(found, CONFIG.session_key))


def trace_sessions(spark, sf_dir):
    """Session and time of every trace, from the narrow columns alone."""
    return with_session(traces(spark, sf_dir)).select(
        "trace_id", "session_id", "request_time", "state"
    )


def turns_and_sizes(spark, sf_dir):
    """Clean turns, and the sessions of all traces: a narrow table to count sizes on."""
    found = traces(spark, sf_dir)
    return ingest.clean_turns(found, CONFIG), with_session(found).select("session_id")


def examples(spark, sf_dir):
    found, sizes = turns_and_sizes(spark, sf_dir)
    return sessions.unroll_examples(found, CONFIG, sizes)


def stored_examples(spark, sf_dir):
    """Examples with their transcript; the same history as messages is left out."""
    return materialize(examples(spark, sf_dir).drop("messages"), "examples")


def scored_examples(spark, sf_dir):
    found = stored_examples(spark, sf_dir)
    answers = stubs.judge_answers(found, "judge", CONFIG)
    return scoring.score_examples(found, answers, "judge", CONFIG)


def stored_curated(spark, sf_dir):
    return materialize(scoring.keep_good(scored_examples(spark, sf_dir), CONFIG), "curated")


def generated(curated):
    answers = stubs.generate_answers(curated, CONFIG)
    return synthesis.generate_examples(curated, answers, CONFIG)


def synthetic_scored(curated):
    to_judge = materialize(synthesis.synthetic_judge_input(generated(curated)), "to-judge")
    answers = stubs.judge_answers(to_judge, "judge_synthetic", CONFIG)
    return synthesis.judge_synthetic(to_judge, answers, CONFIG)


def kept_synthetic(curated):
    return synthesis.keep_synthetic(synthetic_scored(curated), CONFIG)


def training(spark, sf_dir):
    curated = stored_curated(spark, sf_dir)
    return assembly.training_data(curated, kept_synthetic(curated))


def stored_training(spark, sf_dir):
    return materialize(training(spark, sf_dir), "training")


def one_row_per_message(df: DataFrame, messages, *keys: str) -> DataFrame:
    exploded = df.select(*keys, F.posexplode(messages).alias("position", "message"))
    return exploded.select(
        *keys,
        F.col("position").cast("bigint").alias("position"),
        "message.role",
        "message.content",
    )


def millis(name: str, alias: str):
    return F.unix_millis(name).alias(alias)


# ---- traces ----


@query
def trace_scan_limit(spark, sf_dir):
    newest = ingest.scan_traces(traces(spark, sf_dir), 100)
    return newest.select("trace_id", millis("request_time", "request_time_ms"), "state")


@query
def trace_schema_evolution(spark, sf_dir):
    new = traces(spark, sf_dir)
    old = new.drop("request_time").withColumnsRenamed(
        {"state": "status", "trace_metadata": "request_metadata"}
    )
    # Where the first column of a pair is there but holds nothing, its alternate is used.
    mixed = new.withColumns(
        {
            "request_metadata": F.col("trace_metadata"),
            "trace_metadata": F.lit(""),
            "request_time": F.lit(None).cast("timestamp"),
        }
    )
    layouts = {"new": new, "old": old, "mixed": mixed}
    parts = [
        ingest.normalize_traces(rows, CONFIG).select(
            F.lit(layout).alias("layout"),
            "trace_id",
            "session_id",
            millis("request_time", "request_time_ms"),
            "state",
        )
        for layout, rows in layouts.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def trace_status_filter(spark, sf_dir):
    rows = traces(spark, sf_dir)
    return rows.filter(ingest.is_success(rows, CONFIG.success_states)).select("trace_id", "state")


@query
def extract_request(spark, sf_dir):
    return normalized(spark, sf_dir).select("trace_id", "request")


@query
def extract_response(spark, sf_dir):
    return normalized(spark, sf_dir).select("trace_id", "response")


@query
def drop_empty_turns(spark, sf_dir):
    rows = normalized(spark, sf_dir)
    return rows.filter(ingest.is_complete(F.col("request"), F.col("response"))).select(
        "trace_id", "request", "response"
    )


@query
def drop_system_prompts(spark, sf_dir):
    rows = normalized(spark, sf_dir)
    housekeeping = ingest.is_housekeeping(F.col("request"), CONFIG.housekeeping_phrases)
    return rows.filter(~housekeeping).select("trace_id", "request")


@query
def parse_metadata(spark, sf_dir):
    rows = traces(spark, sf_dir)
    value = ingest.payload.metadata_value(
        F.col("trace_metadata"), rows.schema["trace_metadata"].dataType, CONFIG.session_key
    )
    return rows.select(
        "trace_id",
        F.coalesce(ingest.payload.unquoted(value), F.lit("")).alias("session_value"),
        ingest.unreadable_metadata(rows).alias("unreadable"),
    )


@query
def session_id(spark, sf_dir):
    return trace_sessions(spark, sf_dir).select("trace_id", "session_id")


@query
def clean_turns(spark, sf_dir):
    return turns(spark, sf_dir).select(
        "session_id",
        "trace_id",
        millis("request_time", "request_time_ms"),
        "request",
        "response",
    )


@query
def traces_csv_roundtrip(spark, sf_dir):
    path = new_stage_path(spark, "traces-csv")
    whole = traces(spark, sf_dir)
    flat = tables.flatten_for_csv(whole)
    tables.write_csv(flat, path)
    back = tables.read_csv(spark, path, flat.schema)
    payloads = back.withColumns(
        {name: F.parse_json(name) for name in ("request", "response")}
        | {"spans": F.from_json("spans", whole.schema["spans"].dataType)}
    )
    return payloads.select(
        "trace_id",
        F.col("request_time").alias("request_time_ms"),
        "state",
        ingest.request_text(payloads).alias("request"),
        ingest.response_text(payloads).alias("response"),
        ingest.session_id(payloads, CONFIG.session_key).alias("session_id"),
        F.array_join(F.transform("spans", lambda s: s["span_id"]), ",").alias("span_ids"),
        F.to_json(F.col("spans")[1]["outputs"]).alias("child_outputs"),
        F.col("spans")[0]["attributes"]["Input.length"].alias("input_length"),
    )


@query
def quarantined_traces(spark, sf_dir):
    """A third of the traces with metadata that nothing can be read from."""
    rows = traces(spark, sf_dir)
    broken = F.when(F.col("timestamp_ms") % 3 == 0, "no metadata at all").otherwise(F.col("trace_metadata"))
    found = ingest.quarantined_traces(rows.withColumn("trace_metadata", broken), CONFIG)
    return found.select("trace_id", millis("request_time", "request_time_ms"), "reason")


@query
def traces_json_roundtrip(spark, sf_dir):
    """Lines of the old and the new layout, and lines that broke off."""
    rows = traces(spark, sf_dir)
    kind = F.col("timestamp_ms") % 5
    new = F.to_json(F.struct(*[c for c in rows.columns if c != "timestamp_ms"]))
    old = F.to_json(
        F.struct(
            "trace_id",
            "timestamp_ms",
            F.col("state").alias("status"),
            "request",
            "response",
            F.col("trace_metadata").alias("request_metadata"),
            "spans",
        )
    )
    path = new_stage_path(spark, "traces-json")
    line = F.when(kind == 0, F.substring(new, 1, 40)).when(kind < 3, old).otherwise(new)
    rows.select(line.alias("value")).write.text(path)
    back = tables.read_traces(spark, path, "json")
    read = ingest.normalize_traces(back.filter("_corrupt_record is null"), CONFIG)
    broken = ingest.quarantined_traces(back, CONFIG).filter("reason = 'unreadable line'")
    return read.select(
        F.lit("trace").alias("kind"), "trace_id", "session_id", millis("request_time", "request_time_ms"), "state", "request", "response"
    ).unionByName(
        broken.select(F.lit("broken").alias("kind")), allowMissingColumns=True
    )


# ---- exploring ----


@query
def session_search(spark, sf_dir):
    return explore.session_search(trace_sessions(spark, sf_dir)).select(
        "session_id",
        "traces",
        millis("first_time", "first_time_ms"),
        millis("last_time", "last_time_ms"),
    )


@query
def session_first_trace(spark, sf_dir):
    found = with_session(traces(spark, sf_dir).drop("spans"))
    first = ingest.normalize_traces(explore.session_trace(found, 1), CONFIG)
    return first.select(
        "session_id",
        "trace_id",
        millis("request_time", "request_time_ms"),
        "state",
        "request",
        "response",
    )


@query
def nth_trace(spark, sf_dir):
    return explore.nth_trace(trace_sessions(spark, sf_dir), 3).select(
        "trace_id", "session_id", millis("request_time", "request_time_ms"), "state"
    )


@query
def span_explode(spark, sf_dir):
    return explore.explode_spans(traces(spark, sf_dir))


@query
def root_spans(spark, sf_dir):
    return explore.root_spans(traces(spark, sf_dir)).drop("parent_id")


@query
def span_attr_filter(spark, sf_dir):
    return explore.span_attributes(traces(spark, sf_dir))


# ---- sessions and examples ----


def numbered_turns(spark, sf_dir, config):
    found, sizes = turns_and_sizes(spark, sf_dir)
    return sessions.sessionize(found, config, sizes).select(
        "session_id",
        "trace_id",
        F.col("turn_no").cast("bigint").alias("turn_no"),
        "request",
        "response",
    )


@query
def sessionize(spark, sf_dir):
    return numbered_turns(spark, sf_dir, CONFIG)


@query
def sessionize_range(spark, sf_dir):
    """The same by range partitioning, which is how hot sessions are numbered."""
    return numbered_turns(spark, sf_dir, LONG)


def late(found):
    """A third of the turns, dealt over all sessions, comes after the rest."""
    return F.unix_millis("request_time") % 3 == 0


def session_log(spark, sf_dir):
    """A log of two batches; the second holds the late turns and repeats earlier ones."""
    found = materialize(turns(spark, sf_dir), "turns")
    again = F.unix_millis("request_time") % 5 == 1
    path = new_stage_path(spark, "session-log")
    increments.append_turns(found.filter(~late(found)), path, 0, CONFIG)
    increments.append_turns(found.filter(late(found) | again), path, 1, CONFIG)
    return path


def noted(spark, sf_dir):
    """Every message with itself as metadata, written as Python writes a dict; some are broken."""
    escaped = F.col("text")
    for plain, escape in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(escape))
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    session = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.concat(F.lit("conv-"), conv)).otherwise(
        F.concat(F.lit("'conv-"), conv, F.lit("'"))
    )
    literal = F.concat(
        F.lit("{'mlflow.trace.session': "), session, F.lit(", 'note': '"), escaped, F.lit("', \"it's\": ('a', "), turn,
        F.lit(",), 'inner': {'flag': True, 'none': None, 'list': [1, -2.50, "), conv, F.lit("]}}"),
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", literal.alias("trace_metadata"))


@query
def metadata_literals(spark, sf_dir):
    """Every key of metadata in Python literals; what is none is unreadable."""
    found = noted(spark, sf_dir)
    kind = found.schema["trace_metadata"].dataType
    meta = ingest.payload.metadata_object(F.col("trace_metadata"), kind)
    get = lambda path, to: F.try_variant_get("meta", path, to)
    return found.select("conv_id", "turn", "trace_metadata", meta.alias("meta")).select(
        "conv_id",
        "turn",
        get("$['mlflow.trace.session']", "string").alias("session"),
        get("$.note", "string").alias("note"),
        get("$[\"it's\"][1]", "bigint").alias("place"),
        get("$.inner.flag", "boolean").alias("flag"),
        get("$.inner.list[2]", "bigint").alias("last"),
        F.to_json(get("$.inner", "variant")).alias("inner"),
        ingest.unreadable_metadata(found).alias("unreadable"),
    )


@query
def sessions_after_append(spark, sf_dir):
    """Sessions as a log of two batches leaves them: the same as built at once."""
    found = increments.read_sessions(spark, session_log(spark, sf_dir))
    return found.select(
        "session_id", "trace_id", F.col("turn_no").cast("bigint").alias("turn_no"), "request", "response"
    )


@query
def session_changes(spark, sf_dir):
    """What the late turns add to sessions and which others they renumber."""
    log = increments.open_log(spark, session_log(spark, sf_dir)).filter("batch = 1")
    return log.select("session_id", "trace_id", F.col("turn_no").cast("bigint").alias("turn_no"), "change")


def listed_examples(found):
    return found.select(
        "example_id",
        "session_id",
        F.col("turn_no").cast("bigint").alias("turn_no"),
        F.size("messages").cast("bigint").alias("n_messages"),
        "conversation_str",
        "target_response",
    )


@query
def unroll_examples(spark, sf_dir):
    return listed_examples(examples(spark, sf_dir))


@query
def unroll_examples_blocks(spark, sf_dir):
    """The same by way of blocks, which is how long histories are built."""
    found, sizes = turns_and_sizes(spark, sf_dir)
    return listed_examples(sessions.unroll_examples(found, LONG, sizes))


def stored_chain(spark, sf_dir):
    found, sizes = turns_and_sizes(spark, sf_dir)
    return materialize(histories.chain_turns(found, CONFIG, sizes), "chain")


@query
def unroll_examples_chain(spark, sf_dir):
    """The same from turns that are stored once, in blocks of two."""
    return listed_examples(histories.render_examples(stored_chain(spark, sf_dir), None, LONG))


@query
def rendered_requests(spark, sf_dir):
    """The prompts left to ask, when only those are rendered from the stored turns."""
    chain = stored_chain(spark, sf_dir)
    found = completions.with_judge_key(histories.render_examples(chain, None, LONG), config=CONFIG)
    keys = materialize(found.select("example_id", "session_id", "turn_no", "request_key"), "keys")
    good = scoring.keep_good(scored_examples(spark, sf_dir), CONFIG)
    answered = completions.with_judge_key(good, config=CONFIG).select("request_key")
    example = F.min(F.struct("example_id", "session_id", "turn_no")).alias("example")
    left = keys.join(answered, "request_key", "left_anti").groupBy("request_key").agg(example)
    wanted = materialize(left.select("request_key", "example.*"), "wanted")
    rendered = histories.render_examples(chain, wanted, LONG)
    return completions.keyed_judge_requests(rendered, config=CONFIG).select(
        "request_key", F.element_at("messages", 2)["content"].alias("prompt")
    )


@query
def format_transcript(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "example_id", T.format_transcript(F.col("messages")).alias("transcript")
    )


@query
def parse_transcript(spark, sf_dir):
    parsed = T.parse_transcript(F.col("conversation_str"))
    return one_row_per_message(examples(spark, sf_dir), parsed, "example_id")


@query
def last_user_message(spark, sf_dir):
    parsed = T.parse_transcript(F.col("conversation_str"))
    return examples(spark, sf_dir).select(
        "example_id", T.last_user_message(parsed).alias("user_input")
    )


@query
def messages_json(spark, sf_dir):
    there_and_back = T.messages_from_json(T.messages_to_json(F.col("messages")))
    return one_row_per_message(examples(spark, sf_dir), there_and_back, "example_id")


# ---- text over whole documents ----


@query
def text_normalize(spark, sf_dir):
    stripped = T.pystrip(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(stripped).cast("bigint").alias("n_stripped"),
        F.md5(stripped).alias("stripped_md5"),
        F.md5(F.lower(stripped)).alias("lower_md5"),
        F.md5(F.upper(stripped)).alias("upper_md5"),
        F.contains(F.lower("text"), F.lit("license")).alias("has_license"),
    )


@query
def placeholder_flags(spark, sf_dir):
    """Documents and every line of them."""
    documents = table(spark, sf_dir, "documents")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    whole = documents.select("doc_id", F.lit(-1).alias("line"), "text")
    return whole.unionByName(lines).select(
        "doc_id",
        F.col("line").cast("bigint").alias("line"),
        T.is_placeholder(F.col("text")).alias("placeholder"),
        T.is_placeholder(F.col("text"), T.BLANK).alias("strict_placeholder"),
    )


@query
def length_budget(spark, sf_dir):
    return report.length_budget(table(spark, sf_dir, "documents"), "text", CONFIG).select(
        "doc_id", "n_tokens", "kept_tokens", "over_budget"
    )


@query
def token_truncation(spark, sf_dir):
    cut = report.truncate_tokens(table(spark, sf_dir, "documents"), "text", CONFIG)
    return cut.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


@query
def template_render(spark, sf_dir):
    rendered = render_template(
        "Asked:\n{{ request }}\nAnswered ({{session}}):\n{{ response }}\n",
        request=F.col("request"),
        response=F.col("response"),
        session=F.col("session_id"),
    )
    return turns(spark, sf_dir).select("trace_id", rendered.alias("rendered"))


# ---- judging ----


@query
def judge_requests(spark, sf_dir):
    requests = completions.judge_requests(examples(spark, sf_dir), config=CONFIG)
    return one_row_per_message(
        requests.withColumn("max_tokens", F.col("max_tokens").cast("bigint")),
        F.col("messages"),
        "request_key",
        "stage",
        "example_id",
        "max_tokens",
    )


@query
def dedupe_requests(spark, sf_dir):
    """Every example asked about twice, answered once."""
    found = stored_examples(spark, sf_dir)
    requests = completions.judge_requests(found.unionByName(found), config=CONFIG)
    return completions.dedupe_requests(requests).select(
        "request_key", "stage", F.element_at("messages", 2)["content"].alias("prompt")
    )


@query
def pending_requests(spark, sf_dir):
    """Requests left when the answers for good examples are there already."""
    scored = materialize(scored_examples(spark, sf_dir), "scored")
    good = completions.with_judge_key(scoring.keep_good(scored, CONFIG), config=CONFIG)
    requests = completions.judge_requests(scored, config=CONFIG)
    return completions.pending_requests(requests, good).select(
        "request_key", F.element_at("messages", 2)["content"].alias("prompt")
    )


@query
def attach_completions(spark, sf_dir):
    found = stored_examples(spark, sf_dir)
    answers = stubs.judge_answers(found, "judge", CONFIG)
    keyed = completions.with_judge_key(found, "judge", CONFIG)
    return completions.attach_completions(keyed, answers).select(
        "example_id", "session_id", "completion"
    )


@query
def judge_content(spark, sf_dir):
    found = stored_examples(spark, sf_dir)
    answers = stubs.judge_answers(found, "judge", CONFIG)
    content = completions.completion_text(F.col("raw"), answers.schema["raw"].dataType)
    return answers.select("request_key", content.alias("judge_content"))


@query
def parse_score(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "example_id", T.parse_score(stubs.judge_text()).alias("quality_score")
    )


@query
def parse_reason(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "example_id", T.parse_reason(stubs.judge_text()).alias("judge_reason")
    )


@query
def scores_report(spark, sf_dir):
    return scoring.scores_report(scored_examples(spark, sf_dir), CONFIG)


@query
def curated_traces(spark, sf_dir):
    found = materialize(examples(spark, sf_dir), "examples")
    answers = stubs.judge_answers(found, "judge", CONFIG)
    return jobs.curate(found, answers, CONFIG).select(
        "example_id",
        "session_id",
        "conversation_str",
        T.format_transcript(F.col("messages")).alias("messages_text"),
        "target_response",
        "judge_content",
        "quality_score",
        "judge_reason",
    )


# ---- synthesis ----


@query
def generation_fanout(spark, sf_dir):
    copies = completions.fan_out(stored_curated(spark, sf_dir), CONFIG.copies)
    return copies.select(
        "example_id", F.col("generation_idx").cast("bigint").alias("generation_idx")
    )


@query
def generate_requests(spark, sf_dir):
    requests = completions.generate_requests(stored_curated(spark, sf_dir), CONFIG).withColumns(
        {name: F.col(name).cast("bigint") for name in ("generation_idx", "max_tokens")}
    )
    return one_row_per_message(
        requests,
        F.col("messages"),
        "request_key",
        "stage",
        "example_id",
        "generation_idx",
        "max_tokens",
    )


@query
def parse_tags(spark, sf_dir):
    return generated(stored_curated(spark, sf_dir)).select(
        "example_id",
        F.col("generation_idx").cast("bigint").alias("generation_idx"),
        "generated_content",
        "generated_request",
        "generated_response",
    )


@query
def synthetic_judge_input(spark, sf_dir):
    to_judge = synthesis.synthetic_judge_input(generated(stored_curated(spark, sf_dir)))
    return to_judge.select("example_id", "conversation_str", "target_response")


@query
def synthetic_judged(spark, sf_dir):
    return synthetic_scored(stored_curated(spark, sf_dir)).select(
        "example_id", "judge_content", "quality_score"
    )


@query
def synthetic_kept(spark, sf_dir):
    curated = stored_curated(spark, sf_dir)
    to_judge = materialize(synthesis.synthetic_judge_input(generated(curated)), "to-judge")
    kept = jobs.synthesize(
        curated,
        stubs.generate_answers(curated, CONFIG),
        stubs.judge_answers(to_judge, "judge_synthetic", CONFIG),
        CONFIG,
    )
    return kept.select("example_id", "generated_request", "generated_response", "quality_score")


# ---- training data ----


@query
def training_curated(spark, sf_dir):
    return assembly.training_curated(stored_curated(spark, sf_dir))


@query
def training_synthetic(spark, sf_dir):
    return assembly.training_synthetic(kept_synthetic(stored_curated(spark, sf_dir)))


@query
def synthetic_skipped(spark, sf_dir):
    return assembly.synthetic_skipped(kept_synthetic(stored_curated(spark, sf_dir)))


@query
def training_data(spark, sf_dir):
    return training(spark, sf_dir)


@query
def training_csv_roundtrip(spark, sf_dir):
    path = new_stage_path(spark, "training-csv")
    tables.write_csv(training(spark, sf_dir).drop("example_id"), path)
    return tables.read_csv(spark, path, TRAINING)


@query
def source_counts(spark, sf_dir):
    return report.source_counts(training(spark, sf_dir))


@query
def stage_counts(spark, sf_dir):
    """The counts of all stages, each taken in one pass over its stored table."""
    found = stored_examples(spark, sf_dir)
    answers = stubs.judge_answers(found, "judge", CONFIG)
    scored = materialize(scoring.score_examples(found, answers, "judge", CONFIG), "scored")
    curated = scoring.keep_good(scored, CONFIG)
    rejudged = materialize(synthetic_scored(curated), "rejudged")
    kept = synthesis.keep_synthetic(rejudged, CONFIG)
    final = assembly.training_data(curated, kept).agg(F.count("*").alias("rows"))
    skipped = assembly.synthetic_skipped(kept).agg(F.count("*").alias("skipped"))
    parts = [
        report.as_metrics(report.turn_counts(found), "examples"),
        report.as_metrics(report.judge_counts(scored, CONFIG), "judge"),
        report.as_metrics(report.judge_counts(rejudged, CONFIG), "judge_synthetic"),
        report.as_metrics(final, "training"),
        report.as_metrics(skipped, "training"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- splits, chat text, evaluation ----


@query
def holdout_split(spark, sf_dir):
    holdout, _ = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    return holdout


@query
def trainval_split(spark, sf_dir):
    _, rest = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    return rest


def assigned(spark, sf_dir):
    _, rest = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    return splits.split_validation(rest, CONFIG)


@query
def train_val_split(spark, sf_dir):
    return assigned(spark, sf_dir).select("example_id", "split")


@query
def group_split(spark, sf_dir):
    """Whole sessions to the holdout."""
    found = stored_examples(spark, sf_dir).select("example_id", "session_id")
    return splits.split_groups(found, "session_id", CONFIG)


@query
def leak_free_split(spark, sf_dir):
    """No session, seed or input on two sides of the splits."""
    curated = stored_curated(spark, sf_dir)
    synthetic = materialize(kept_synthetic(curated), "synthetic")
    found = materialize(assembly.training_data(curated, synthetic), "training")
    links = materialize(assembly.training_links(curated, synthetic), "training-links")
    return splits.split_leak_free(found, links, CONFIG).select("example_id", "component", "split")


@query
def split_counts(spark, sf_dir):
    found = stored_training(spark, sf_dir)
    holdout, rest = splits.split_holdout(found, CONFIG)
    parts = splits.split_validation(rest, CONFIG).select("split")
    return report.split_counts(parts.unionByName(holdout.select(F.lit("holdout").alias("split"))))


@query
def training_plan(spark, sf_dir):
    return report.training_plan(assigned(spark, sf_dir).filter("split = 'train'"), CONFIG)


@query
def chat_text(spark, sf_dir):
    prepared = jobs.prepare(stored_training(spark, sf_dir), CONFIG)
    return prepared.train.unionByName(prepared.validation)


@query
def holdout_roundtrip(spark, sf_dir):
    path = new_stage_path(spark, "holdout-csv")
    holdout, _ = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    tables.write_csv(holdout.drop("example_id"), path)
    return tables.read_csv(spark, path, TRAINING)


@query
def chat_prompt(spark, sf_dir):
    holdout, _ = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    return compare.chat_prompts(holdout)


def compared(spark, sf_dir):
    holdout, _ = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    return compare.eval_results(holdout, stubs.base_answers(holdout), stubs.tuned_answers(holdout))


@query
def eval_results(spark, sf_dir):
    return compared(spark, sf_dir)


@query
def eval_requests(spark, sf_dir):
    holdout, _ = splits.split_holdout(stored_training(spark, sf_dir), CONFIG)
    requests = compare.eval_requests(holdout, "base", CONFIG)
    return one_row_per_message(requests, F.col("messages"), "example_id", "stage")


@query
def eval_preview(spark, sf_dir):
    return compare.eval_preview(compared(spark, sf_dir))


# ---- seeding ----


def numbered_prompts(spark, sf_dir):
    return seeding.number_prompts(prompts(spark, sf_dir), "conv_id", "turn")


@query
def prompt_corpus(spark, sf_dir):
    path = new_stage_path(spark, "prompts")
    corpus = numbered_prompts(spark, sf_dir).select("prompt_index", "category", "prompt")
    tables.write_csv(corpus, path)
    back = tables.read_prompts(spark, path)
    return back.withColumn("prompt_index", F.col("prompt_index").cast("bigint"))


@query
def prompt_requests(spark, sf_dir):
    requests = seeding.prompt_requests(numbered_prompts(spark, sf_dir), SYSTEM)
    return one_row_per_message(requests, F.col("messages"), "request_key", "stage", "prompt_index")


@query
def trace_tags(spark, sf_dir):
    tagged = seeding.tag_prompts(numbered_prompts(spark, sf_dir), RUN_ID)
    return tagged.select(
        "prompt_index",
        "session_id",
        "run_name",
        F.explode("tags").alias("tag", "value"),
    )


@query
def seed_traces(spark, sf_dir):
    corpus = numbered_prompts(spark, sf_dir)
    seeded = seeding.seed_traces(corpus, stubs.seed_answers(corpus, SYSTEM), RUN_ID, SYSTEM)
    return seeded.select(
        "trace_id",
        "run_name",
        "state",
        ingest.request_text(seeded).alias("request"),
        ingest.response_text(seeded).alias("response"),
    )


@query
def seeded_turns(spark, sf_dir):
    """Clean turns of a seeded store, curated as it is."""
    corpus = numbered_prompts(spark, sf_dir)
    seeded = seeding.seed_traces(corpus, stubs.seed_answers(corpus, SYSTEM), RUN_ID, SYSTEM)
    return ingest.clean_turns(seeded, CONFIG).select(
        "session_id", "trace_id", millis("request_time", "request_time_ms"), "request", "response"
    )


@query
def seed_preview(spark, sf_dir):
    corpus = numbered_prompts(spark, sf_dir)
    return seeding.seed_preview(corpus, stubs.seed_answers(corpus, SYSTEM), SYSTEM)
