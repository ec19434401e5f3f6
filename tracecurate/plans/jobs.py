"""Whole jobs: seed, curate, synthesize, assemble, prepare and compare.

The functions that take response tables are plain compositions. The ``run_*`` functions
drive whole runs: they store each stage that is read again, ask the model for what has no
answer yet, and write the outputs.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..config import ChatTemplate, CurationConfig
from ..functions.prompts import chat_text
from ..functions.text import format_transcript, message, messages_to_json, parse_transcript
from ..operators.assembly import synthetic_skipped, training_data, training_links
from ..operators.compare import eval_answers, eval_requests, eval_results
from ..operators.completions import (
    Completer,
    complete_pending,
    complete_wanted,
    generate_requests,
    judge_cost,
    judge_requests,
    keyed_judge_requests,
    read_failures,
    with_judge_key,
)
from ..operators.histories import chain_turns, render_examples
from ..operators.increments import latest_deliveries
from ..operators.ingest import clean_turns, quarantined_traces, scan_traces
from ..operators.report import length_budget, training_plan, truncate_tokens, turn_counts, words
from ..operators.scoring import (
    keep_good,
    passes,
    score_examples,
    score_keyed,
    scores_report,
)
from ..operators.seeding import new_run_id, prompt_requests, seed_traces
from ..operators.sessions import unroll_examples
from ..operators.splits import split_holdout, split_leak_free, split_validation, with_example_id
from ..operators.synthesis import (
    generate_examples,
    judge_synthetic,
    keep_synthetic,
    synthetic_judge_input,
)
from ..schema import require_columns
from ..sources.staging import materialize
from ..sources.tables import write_csv
from .manifest import Run, Stage, source_fingerprint


def build_examples(traces: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Traces to training examples, before any judgement."""
    return unroll_examples(clean_turns(scan_traces(traces, config.max_traces), config), config)


def curate(
    examples: DataFrame, judge_responses: DataFrame, config: CurationConfig = CurationConfig()
) -> DataFrame:
    """Examples the judge finds good enough."""
    return keep_good(score_examples(examples, judge_responses, "judge", config), config)


def synthesize(
    curated: DataFrame,
    generate_responses: DataFrame,
    judge_responses: DataFrame,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """Synthetic examples the judge finds good enough."""
    generated = generate_examples(curated, generate_responses, config)
    scored = judge_synthetic(synthetic_judge_input(generated), judge_responses, config)
    return keep_synthetic(scored, config)


def training_text(
    training: DataFrame, template: ChatTemplate = ChatTemplate()
) -> DataFrame:
    """``text``: the parsed conversation and its answer in chat format."""
    messages = F.array_append(
        parse_transcript(F.col("input")), message("assistant", F.col("output"))
    )
    return training.withColumn("text", chat_text(messages, template))


@dataclass(frozen=True)
class PreparedData:
    holdout: DataFrame
    train: DataFrame
    validation: DataFrame


def prepare(
    training: DataFrame,
    config: CurationConfig = CurationConfig(),
    template: ChatTemplate = ChatTemplate(),
    links: DataFrame | None = None,
) -> PreparedData:
    """Split off the holdout, split the rest, render chat text. ``training`` is stored.

    With ``links`` no session, seed or input is on two sides, see ``split_leak_free``.
    """
    if links is None:
        holdout, rest = split_holdout(training, config)
        assigned = split_validation(rest, config)
    else:
        assigned = materialize(split_leak_free(training, links, config), "assigned")
        holdout = assigned.filter("split = 'holdout'").select(training.columns)

    def texts(split: str) -> DataFrame:
        return training_text(assigned.filter(F.col("split") == split), template).select(
            "example_id", "text"
        )

    return PreparedData(holdout, texts("train"), texts("validation"))


# Columns of the stored examples that were kept.
CURATED = (
    "example_id",
    "session_id",
    "turn_no",
    "messages",
    "target_response",
    "judge_content",
    "quality_score",
    "judge_reason",
)


# Settings that decide what a stage holds; those of size, speed and tries do not.
_READ = ("max_traces", "success_states", "housekeeping_phrases", "session_key", "parse_json_strings")
_JUDGE = ("judge_system", "judge_temperature", "judge_max_tokens")
_GENERATE = ("generate_system", "generate_temperature", "generate_max_tokens", "copies")
_SPLIT = ("holdout_fraction", "validation_fraction", "seed")


def _observed(df: DataFrame, seen: Observation, **counts: Column) -> DataFrame:
    """Count rows while they are written, without a job of their own."""
    exprs = [count.alias(metric) for metric, count in counts.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *exprs)


def _with_transcript(df: DataFrame) -> DataFrame:
    return df.withColumn("conversation_str", format_transcript(F.col("messages")))


def run_curation(
    traces: DataFrame,
    complete: Completer,
    out: str,
    config: CurationConfig = CurationConfig(),
    csv: bool = True,
) -> dict[str, int]:
    """Traces to training data below ``out``; returns the counts of the stages.

    Stages that an earlier run over the same files and settings has finished are taken over,
    see ``manifest``. Answers are appended to tables below ``out/responses``; a second run over
    the same traces asks the model nothing.
    """
    run = Run(traces.sparkSession, out, config, source_fingerprint(traces))
    kept = F.count_if(passes(config.score_threshold))
    scanned = cache(lambda: scan_traces(traces, config.max_traces))

    def ask(requests: DataFrame, stage: str, unique_keys: bool = False) -> DataFrame:
        return complete_pending(
            requests,
            f"{out}/responses/{stage}",
            complete,
            config.concurrency,
            config.call_waves,
            unique_keys=unique_keys,
            tasks=config.call_tasks,
            attempts=config.attempts,
            calls_per_second=config.calls_per_second,
        )

    def export(df: DataFrame, name: str, after: Stage) -> None:
        if csv:
            run.step(f"{name}_csv", lambda: write_csv(df, f"{out}/{name}_csv"), [after])

    def sizes(turns: DataFrame) -> dict[str, int]:
        found = turns.agg(F.count("*").alias("n"), F.count_distinct("trace_id").alias("ids")).first()
        return {"rows": found["n"], "distinct": found["ids"], "traces": scanned().count()}

    delivered = run.stage("turns", lambda: clean_turns(scanned(), config), settings=_READ, count=sizes)
    quarantine = run.stage(
        "quarantine",
        lambda: quarantined_traces(scanned(), config),
        settings=_READ,
        count=lambda rows: {"rows": rows.count()},
    )
    turns, repeated = delivered, delivered.counts["rows"] - delivered.counts["distinct"]
    if repeated:  # a trace that was delivered twice is one example
        turns = run.stage("distinct_turns", lambda: latest_deliveries(delivered.table), [delivered])
    # Turns are stored once, with their place. Histories are rendered from them where they are
    # read; stored are only those of the outputs.
    chain = run.stage(
        "chain",
        lambda: chain_turns(turns.table, config),
        [turns],
        count=lambda rows: turn_counts(rows).first().asDict(),
    )

    def keys_of_all() -> DataFrame:
        keyed = with_judge_key(render_examples(chain.table, None, config), config=config)
        return keyed.select("example_id", "session_id", "turn_no", "request_key", judge_cost(config).alias("cost"))

    keys = run.stage("judge_keys", keys_of_all, [chain], _JUDGE)

    def requests_of(wanted: DataFrame) -> DataFrame:
        return keyed_judge_requests(render_examples(chain.table, wanted, config), config=config)

    def judged() -> DataFrame:
        answers = complete_wanted(
            keys.table,
            requests_of,
            f"{out}/responses/judge",
            complete,
            config.concurrency,
            config.call_waves,
            config.call_tasks,
            config.attempts,
            config.calls_per_second,
        )
        return _observed(score_keyed(keys.table.drop("cost"), answers), seen, kept=kept)

    seen = Observation("judged")
    scored = run.stage("scored", judged, [keys], ["score_threshold"], seen)
    report = run.stage(
        "scores_report",
        lambda: scores_report(render_examples(chain.table, scored.table, config), config),
        [chain, scored],
    )
    export(report.table, "scores_report", report)

    def kept_examples() -> DataFrame:
        return render_examples(chain.table, keep_good(scored.table, config), config).select(*CURATED)

    curation = run.stage("curated_traces", kept_examples, [chain, scored])
    flat = curation.table.withColumn("messages", messages_to_json(F.col("messages")))
    export(flat, "curated_traces", curation)
    curated = _with_transcript(curation.table)

    def generated() -> DataFrame:
        seeds = curated.select("example_id", "session_id", "conversation_str", "target_response")
        answers = ask(generate_requests(seeds, config), "generate", unique_keys=True)
        # Of a seed only its ids go on; its texts were needed for the prompt.
        written = generate_examples(seeds, answers, config).drop("conversation_str", "target_response")
        return _observed(written, written_seen)

    written_seen = Observation("generated")
    generation = run.stage("generated", generated, [curation], _GENERATE, written_seen)

    def rejudged() -> DataFrame:
        to_judge = synthetic_judge_input(generation.table)
        answers = ask(judge_requests(to_judge, "judge_synthetic", config), "judge_synthetic")
        return _observed(judge_synthetic(to_judge, answers, config), rejudged_seen, kept=kept)

    rejudged_seen = Observation("rejudged")
    rejudging = run.stage(
        "synthetic_scored", rejudged, [generation], (*_JUDGE, "score_threshold"), rejudged_seen
    )
    synthetic = keep_synthetic(rejudging.table, config)

    def assembled() -> DataFrame:
        real = F.count_if(F.col("source") == "curated")
        return _observed(training_data(curated, synthetic), assembled_seen, curated=real)

    assembled_seen, sides = Observation("training"), [curation, rejudging]
    training = run.stage("training_data", assembled, sides, seen=assembled_seen)
    export(training.table.drop("example_id"), "training_data", training)
    run.stage("training_links", lambda: training_links(curated, synthetic), sides)
    run.stage("synthetic_skipped", lambda: synthetic_skipped(synthetic), sides)

    first, second, final = scored.counts, rejudging.counts, training.counts
    return {
        "traces": delivered.counts["traces"],
        "quarantined": quarantine.counts["rows"],
        "repeated_traces": repeated,
        "sessions": chain.counts["sessions"],
        "examples": first["rows"],
        "kept": first["kept"],
        "generated": generation.counts["rows"],
        "synthetic_unparsed": generation.counts["rows"] - second["rows"],
        "synthetic_judged": second["rows"],
        "synthetic_kept": second["kept"],
        "synthetic_skipped": second["kept"] - (final["rows"] - final["curated"]),
        "training_rows": final["rows"],
    }


def _with_unique_ids(rows: DataFrame) -> DataFrame:
    """Splits and joins go by ``example_id``; rows that share one are an error of the input."""
    found = rows.agg(F.count("*").alias("n"), F.count_distinct("example_id").alias("ids")).first()
    if found["ids"] < found["n"]:
        raise ValueError(f"{found['n']} rows have {found['ids']} distinct values of example_id")
    return rows


def _sources(*tables: DataFrame | None) -> str | None:
    """One fingerprint of several inputs, None if one of them has none."""
    found = [source_fingerprint(table) for table in tables if table is not None]
    return None if None in found else "|".join(found)


def run_preparation(
    training: DataFrame,
    out: str,
    config: CurationConfig = CurationConfig(),
    template: ChatTemplate = ChatTemplate(),
    csv: bool = True,
    tokens=words,
    links: DataFrame | None = None,
    tokenized: bool = False,
) -> dict[str, int]:
    """Training rows to a holdout and to chat texts below ``out``; returns sizes and plan.

    ``links``, the table ``training_links`` of a curation run, makes the splits free of leaks.

    Chat texts come with their length in ``tokens``, what the sequence cap leaves of it, and
    whether it cuts. With ``tokenized`` their tokens, cut at the cap, are stored as well, in
    ``train_tokens`` and ``validation_tokens``. Finished stages are taken over as in
    ``run_curation``, those that call a tokenizer of the caller are not.
    """
    run = Run(training.sparkSession, out, config, _sources(training, links))
    own = repr(template) if tokens is words else uuid.uuid4().hex

    def unique() -> DataFrame:
        return training if "example_id" in training.columns else with_example_id(training)

    def one_an_id(rows: DataFrame) -> dict[str, int]:
        _with_unique_ids(rows)
        return {}

    source = run.stage("training", unique, count=one_an_id)
    prepared = cache(lambda: prepare(source.table, config, template, links))
    holdout = run.stage("holdout", lambda: prepared().holdout, [source], _SPLIT)
    if csv:
        rows = holdout.table.drop("example_id")
        run.step("holdout_csv", lambda: write_csv(rows, f"{out}/holdout_csv"), [holdout])

    def part(name: str, count=None) -> Stage:
        texts = run.stage(
            name,
            lambda: length_budget(getattr(prepared(), name), "text", config, tokens),
            [source],
            (*_SPLIT, "max_sequence_tokens"),
            count=count,
            also=own,
        )
        if tokenized:
            cut = lambda: truncate_tokens(texts.table.select("example_id", "text"), "text", config, tokens)
            run.stage(f"{name}_tokens", cut, [texts])
        return texts

    part("validation")
    train = part("train", lambda rows: {"over_budget": rows.filter("over_budget").count()})
    return training_plan(train.table, config).first().asDict() | train.counts


def run_evaluation(
    holdout: DataFrame,
    complete_base: Completer,
    complete_tuned: Completer,
    out: str,
    config: CurationConfig = CurationConfig(),
    csv: bool = True,
) -> DataFrame:
    """Both models' answers to the holdout side by side, stored below ``out``.

    ``holdout`` may be the stored table or its CSV export, which has no ids.
    """
    require_columns(holdout, ["source", "input", "output"])
    if "example_id" not in holdout.columns:
        holdout = with_example_id(holdout)
    holdout = _with_unique_ids(materialize(holdout, "holdout", f"{out}/holdout"))

    def answers(model: str, complete: Completer) -> DataFrame:
        responses = complete_pending(
            eval_requests(holdout, model, config),
            f"{out}/responses/{model}",
            complete,
            config.concurrency,
            config.call_waves,
            tasks=config.call_tasks,
            attempts=config.attempts,
            calls_per_second=config.calls_per_second,
        )
        return eval_answers(holdout, responses, model, config)

    results = materialize(
        eval_results(holdout, answers("base", complete_base), answers("tuned", complete_tuned)),
        "eval_results",
        f"{out}/eval_results",
    )
    if csv:
        write_csv(results.drop("example_id"), f"{out}/eval_results_csv")
    return results


def run_seeding(
    prompts: DataFrame,
    complete: Completer,
    out: str,
    system: str,
    run_id: str | None = None,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """Ask the model every prompt of a corpus under the caller's ``system`` text and store
    the traces below ``out``. They can be curated as they are."""
    path, settings = f"{out}/responses/seed", (config.seed_temperature, config.seed_max_tokens)
    begun_ms = int(time.time() * 1000)
    responses = complete_pending(
        prompt_requests(prompts, system, *settings),
        path,
        complete,
        config.concurrency,
        config.call_waves,
        skip_errors=True,
        unique_keys=True,
        tasks=config.call_tasks,
        attempts=config.attempts,
        calls_per_second=config.calls_per_second,
    )
    failures = read_failures(prompts.sparkSession, path)
    traces = seed_traces(prompts, responses, run_id or new_run_id(), system, failures, begun_ms, *settings)
    return materialize(traces, "traces", f"{out}/traces")
