"""DuckDB SQL for every query. Written from the definitions, not from the Spark code."""

from __future__ import annotations

from tracecurate.functions import prompts as P

_REQUEST, _RESPONSE = "user_request", "assistant_response"
_SEED_SYSTEM = "Answer in full."


def _text(value: str) -> str:
    """A Python string as an SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def _fill(template: str, **columns: str) -> str:
    """A prompt template as an SQL concatenation."""
    sql = _text(template)
    for name, column in columns.items():
        sql = sql.replace("{{ " + name + " }}", f"' || {column} || '")
    return sql


def _strip(column: str) -> str:
    return f"trim({column}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _key(stage: str, temperature: float, tokens: int, system: str, user: str) -> str:
    def one(role: str, content: str) -> str:
        return f"'{role}:' || length({content}) || ':' || {content}"

    body = f"{one('system', _text(system))} || {one('user', user)}"
    return f"sha256('{stage}|{temperature}|{tokens}|' || {body})"


def _copy_key(key: str, copy: str) -> str:
    return f"sha256({key} || '|' || {copy})"


def _judge_user(conversation: str, answer: str) -> str:
    return _fill(P.JUDGE_USER, conversation_str=conversation, target_response=answer)


def _judge_stub(conversation: str, answer: str) -> str:
    return f"""
    CASE (length({conversation}) * 7 + length({answer})) % 23
      WHEN 0 THEN 'I cannot score this.'
      WHEN 1 THEN '**Score:** 9'
      WHEN 2 THEN 'Score: 15' || chr(10) || 'Reason: over range'
      WHEN 3 THEN 'Score: 7.5'
      ELSE 'Score: ' || (1 + ((length({conversation}) * 7 + length({answer})) % 23) % 10)
        || chr(10) || 'Reason: bucket ' || ((length({conversation}) * 7 + length({answer})) % 23)
    END"""


def _score(column: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({column}, 'Score:\\s*(\\d+)', 1), '') AS BIGINT)"


def _reason(column: str) -> str:
    return _strip(f"regexp_extract({column}, 'Reason:\\s*(.+)', 1)")


def _tag(column: str, tag: str) -> str:
    pattern = f"'(?s)<{tag}>(.*?)</{tag}>'"
    found = _strip(f"regexp_extract({column}, {pattern}, 1)")
    return f"CASE WHEN regexp_matches({column}, {pattern}) THEN {found} END"


def _placeholder(column: str, noise: str = r"[\s\\nr]+") -> str:
    clean = f"regexp_replace({column}, '{noise}', '', 'g')"
    return f"""(length({clean}) < 15 OR regexp_full_match({clean}, '\\.{{2,}}')
      OR regexp_full_match({clean}, '(?s)\\[.*\\]'))"""


def _chunks(column: str) -> str:
    """Transcript chunks; DuckDB has no look-ahead, so breaks are marked first."""
    mark = _strip(column)
    for role in ("User: ", "Assistant: "):
        mark = f"replace({mark}, chr(10) || '{role}', chr(1) || '{role}')"
    return f"string_split({mark}, chr(1))"


_ROLE = "CASE WHEN starts_with(c, 'User: ') THEN 'user' WHEN starts_with(c, 'Assistant: ') THEN 'assistant' END"
_CONTENT = f"CASE WHEN starts_with(c, 'User: ') THEN {_strip('c[7:]')} WHEN starts_with(c, 'Assistant: ') THEN {_strip('c[12:]')} END"
_CHATML_SYSTEM = "'<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10)"


def _chat(column: str) -> str:
    turn = f"'<|im_start|>' || {_ROLE} || chr(10) || {_CONTENT} || '<|im_end|>' || chr(10)"
    kept = f"list_filter({_chunks(column)}, lambda c: {_ROLE} IS NOT NULL)"
    return f"{_CHATML_SYSTEM} || array_to_string(list_transform({kept}, lambda c: {turn}), '')"


_GEN_KEY = _copy_key(
    _key(
        "generate",
        0.8,
        8192,
        P.GENERATE_SYSTEM,
        _fill(
            P.GENERATE_USER,
            conversation_str="conversation_str",
            target_response="target_response",
        ),
    ),
    "example_id || '#' || i",
)
_GEN_BUCKET = "(length(conversation_str) + 31 * i + length(target_response)) % 11"
_U, _EU, _A, _EA = f"<{_REQUEST}>", f"</{_REQUEST}>", f"<{_RESPONSE}>", f"</{_RESPONSE}>"

_CTES = {
    "traces": """
    SELECT 'tr-' || u.conv_id || '-' || u.turn AS trace_id, u.conv_id, u.turn,
      u.conv_id * 1000 + u.turn AS request_time_ms,
      CASE (u.conv_id * 7 + u.turn) % 17
        WHEN 0 THEN 'ERROR' WHEN 2 THEN 'ok' WHEN 4 THEN 'TRACE_STATE_OK' ELSE 'OK' END AS state,
      CASE WHEN (u.conv_id + u.turn) % 19 = 0
        THEN 'Please REVIEW the conversation above. ' ELSE '' END || u.text AS asked,
      CASE WHEN u.nr = 'assistant' THEN u.nt ELSE '' END AS answered,
      CASE WHEN u.conv_id % 5 = 0 THEN 'tr-' || u.conv_id || '-' || u.turn
        ELSE 'conv-' || u.conv_id END AS session_id
    FROM (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) u
    WHERE u.role = 'user'""",
    "normalized": f"""
    SELECT trace_id, session_id, request_time_ms, state,
      {_strip("asked")} AS request, {_strip("answered")} AS response
    FROM traces""",
    "turns": """
    SELECT session_id, trace_id, request_time_ms, request, response FROM normalized
    WHERE upper(state) IN ('OK', 'TRACE_STATE_OK') AND request <> '' AND response <> ''
      AND NOT contains(lower(request), 'review the conversation above')
      AND NOT contains(lower(request), 'update the skill library')
      AND NOT contains(lower(request), 'a pass that does nothing')""",
    "examples": """
    SELECT trace_id AS example_id, session_id, row_number() OVER w AS turn_no,
      coalesce(string_agg('User: ' || request || chr(10) || 'Assistant: ' || response || chr(10), '')
        OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
        || 'User: ' || request AS conversation_str,
      response AS target_response, request, response
    FROM turns WINDOW w AS (PARTITION BY session_id ORDER BY request_time_ms, trace_id)""",
    "judged": f"""
    SELECT *, {_judge_stub("conversation_str", "target_response")} AS judge_content
    FROM examples""",
    "scored": f"""
    SELECT *, {_score("judge_content")} AS quality_score, {_reason("judge_content")} AS judge_reason
    FROM judged""",
    "curated": "SELECT * FROM scored WHERE quality_score >= 7",
    "seeds": "SELECT c.*, s.i FROM curated c, (SELECT unnest([0, 1, 2]) AS i) s",
    "answers": f"""
    SELECT *,
      'Synthetic request ' || i || ' for ' || example_id || ' '
        || repeat('x', length(conversation_str) % 37) AS rq,
      'Synthetic answer ' || i || ' covering ' || length(target_response) || ' characters '
        || repeat('y', length(target_response) % 29) AS rs,
      {_GEN_BUCKET} AS bucket
    FROM seeds""",
    "written": f"""
    SELECT *, CASE bucket
      WHEN 0 THEN 'no tags here'
      WHEN 1 THEN '{_U}' || rq || '{_EU}{_A}[' || rs || ']{_EA}'
      WHEN 2 THEN '{_U}short' || repeat('n', length(conversation_str) % 37) || '{_EU}{_A}' || rs || '{_EA}'
      WHEN 3 THEN '{_U}' || rq || '{_EU}{_A}' || rs
      WHEN 4 THEN '{_U}' || rq || '{_EU}{_A}' || rs || '{_EA}' || chr(10)
        || '{_U}second{_EU}{_A}second{_EA}'
      WHEN 5 THEN '{_U} USER:  ' || rq || ' {_EU}{_A}' || rs || '{_EA}'
      ELSE '{_U}' || chr(10) || rq || chr(10) || '{_EU}' || chr(10)
        || '{_A}' || chr(10) || rs || chr(10) || '{_EA}' END AS generated_content
    FROM answers""",
    "generated": f"""
    SELECT *, {_tag("generated_content", _REQUEST)} AS generated_request,
      {_tag("generated_content", _RESPONSE)} AS generated_response
    FROM written""",
    "to_judge": """
    SELECT example_id || '#' || i AS example_id, session_id, generated_request, generated_response,
      'User: ' || generated_request AS conversation_str, generated_response AS target_response
    FROM generated WHERE generated_request IS NOT NULL AND generated_response IS NOT NULL""",
    "rejudged_text": f"""
    SELECT *, {_judge_stub("conversation_str", "target_response")} AS judge_content
    FROM to_judge""",
    "rejudged": f"SELECT *, {_score('judge_content')} AS quality_score FROM rejudged_text",
    "kept": "SELECT * FROM rejudged WHERE quality_score >= 7",
    "cleaned": f"""
    SELECT *, regexp_replace({_strip("generated_request")}, '^user:\\s*', '', 'i') AS req,
      {_strip("generated_response")} AS res FROM kept""",
    "reasoned": f"""
    SELECT *, CASE WHEN req = '' THEN 'empty request' WHEN res = '' THEN 'empty response'
      WHEN {_placeholder("req")} THEN 'placeholder request'
      WHEN {_placeholder("res")} THEN 'placeholder response' END AS reason FROM cleaned""",
    "real_rows": f"""
    SELECT example_id, 'curated' AS source, conversation_str AS input,
      {_strip("target_response")} AS output
    FROM curated WHERE NOT {_placeholder("target_response")}""",
    "synthetic_rows": """
    SELECT example_id, 'synthetic' AS source, 'User: ' || req AS input, res AS output
    FROM reasoned WHERE reason IS NULL""",
    "training": "SELECT * FROM real_rows UNION ALL SELECT * FROM synthetic_rows",
    "drawn": """
    SELECT *, row_number() OVER (ORDER BY md5(example_id || ':42'), example_id) AS place,
      count(*) OVER () AS n FROM training""",
    "holdout": """
    SELECT example_id, source, input, output FROM drawn
    WHERE place <= round_even(CAST(0.1 AS DOUBLE) * n, 0)""",
    "rest": """
    SELECT example_id, source, input, output FROM drawn
    WHERE place > round_even(CAST(0.1 AS DOUBLE) * n, 0)""",
    "redrawn": """
    SELECT *, row_number() OVER (ORDER BY md5(example_id || ':43'), example_id) AS place,
      count(*) OVER () AS n FROM rest""",
    "assigned": """
    SELECT example_id, input, output,
      CASE WHEN place <= ceil(CAST(0.1 AS DOUBLE) * n) THEN 'validation' ELSE 'train' END AS split
    FROM redrawn""",
    "compared": f"""
    SELECT example_id, source,
      coalesce(list_filter({_chunks("input")}, lambda c: starts_with(c, 'User: '))[-1][7:], '')
        AS user_input,
      output AS reference, 'base ' || md5(input) AS base_response,
      'tuned ' || md5(input || output) AS finetuned_response
    FROM holdout""",
    "prompts": """
    SELECT row_number() OVER (ORDER BY conv_id, turn) AS prompt_index,
      CASE WHEN contains(text, '?') THEN 'question' ELSE 'statement' END AS category,
      text AS prompt
    FROM conversations WHERE role = 'user'""",
}


def _sql(select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items()) + "\n" + select


def _messages(keys: str, source: str, system: str, user: str) -> str:
    return f"""
    SELECT {keys}, CAST(0 AS BIGINT) AS position, 'system' AS role, {_text(system)} AS content
    FROM {source}
    UNION ALL SELECT {keys}, 1, 'user', {user} FROM {source}"""


def _parsed(source: str, column: str = "conversation_str", extra: str = "") -> str:
    parts = f"list_filter({_chunks(column)}, lambda c: {_ROLE} IS NOT NULL)"
    return f"""
    SELECT example_id, position, {_ROLE} AS role, {_CONTENT} AS content{extra} FROM (
      SELECT example_id, unnest({parts}) AS c,
        CAST(generate_subscripts({parts}, 1) - 1 AS BIGINT) AS position FROM {source})"""


_JUDGE_KEY = _key(
    "judge", 0.0, 1024, P.JUDGE_SYSTEM, _judge_user("conversation_str", "target_response")
)
_LAYOUT = "SELECT '{0}' AS layout, trace_id, session_id, request_time_ms, state FROM traces"
_BLANK_RUN = r"[ \t\n\x0b\f\r]+"
_TOKENS = f"list_filter(string_split_regex(text, '{_BLANK_RUN}'), lambda w: w <> '')"

_SELECTS = {
    "trace_scan_limit": """SELECT trace_id, request_time_ms, state FROM traces
        ORDER BY request_time_ms DESC, trace_id LIMIT 100""",
    "trace_schema_evolution": " UNION ALL ".join(
        _LAYOUT.format(name) for name in ("new", "old", "mixed")
    ),
    "trace_status_filter": """SELECT trace_id, state FROM traces
        WHERE upper(state) IN ('OK', 'TRACE_STATE_OK')""",
    "extract_request": "SELECT trace_id, request FROM normalized",
    "extract_response": "SELECT trace_id, response FROM normalized",
    "drop_empty_turns": """SELECT trace_id, request, response FROM normalized
        WHERE request <> '' AND response <> ''""",
    "drop_system_prompts": """SELECT trace_id, request FROM normalized
        WHERE NOT contains(lower(request), 'review the conversation above')
          AND NOT contains(lower(request), 'update the skill library')
          AND NOT contains(lower(request), 'a pass that does nothing')""",
    "parse_metadata": """SELECT trace_id,
        CASE WHEN session_id = trace_id THEN '' ELSE session_id END AS session_value,
        false AS unreadable FROM traces""",
    "session_id": "SELECT trace_id, session_id FROM traces",
    "clean_turns": "SELECT session_id, trace_id, request_time_ms, request, response FROM turns",
    "traces_csv_roundtrip": """SELECT trace_id, request_time_ms, state, request, response,
        session_id, trace_id || '-root,' || trace_id || '-child' AS span_ids,
        to_json({'text': t.answered})::VARCHAR AS child_outputs, length(t.asked)::VARCHAR AS input_length
        FROM normalized JOIN (SELECT trace_id, asked, answered FROM traces) t USING (trace_id)""",
    "quarantined_traces": """SELECT trace_id, request_time_ms, 'unreadable metadata' AS reason
        FROM turns WHERE request_time_ms % 3 = 0""",
    "traces_json_roundtrip": """
        SELECT 'trace' AS kind, trace_id, session_id, request_time_ms, state, request, response
        FROM normalized WHERE request_time_ms % 5 <> 0
        UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, NULL, NULL
        FROM normalized WHERE request_time_ms % 5 = 0""",
    "session_search": """SELECT session_id, count(*) AS traces,
        min(request_time_ms) AS first_time_ms, max(request_time_ms) AS last_time_ms
        FROM traces GROUP BY session_id""",
    "session_first_trace": """SELECT session_id, trace_id, request_time_ms, state, request, response
        FROM normalized
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY request_time_ms, trace_id) = 1""",
    "nth_trace": """SELECT trace_id, session_id, request_time_ms, state FROM traces
        ORDER BY request_time_ms DESC, trace_id LIMIT 1 OFFSET 2""",
    "span_explode": """
        SELECT trace_id, trace_id || '-root' AS span_id, NULL AS parent_id, 'answer' AS name,
          'CHAIN' AS span_type, to_json({'text': asked})::VARCHAR AS inputs,
          to_json({'text': answered})::VARCHAR AS outputs FROM traces
        UNION ALL SELECT trace_id, trace_id || '-child', trace_id || '-root', 'chat',
          'CHAT_MODEL', to_json({'text': asked})::VARCHAR, to_json({'text': answered})::VARCHAR
        FROM traces""",
    "root_spans": """
        SELECT trace_id, trace_id || '-root' AS span_id, 'answer' AS name, 'CHAIN' AS span_type,
          to_json({'text': asked})::VARCHAR AS inputs,
          to_json({'text': answered})::VARCHAR AS outputs FROM traces""",
    "span_attr_filter": """
        SELECT trace_id, trace_id || '-root' AS span_id, 'answer' AS name,
          'Input.length' AS key, length(asked)::VARCHAR AS value FROM traces
        UNION ALL SELECT trace_id, trace_id || '-child', 'chat', 'gen_ai.system', 'stub' FROM traces
        UNION ALL SELECT trace_id, trace_id || '-child', 'chat', 'LLM.output',
          length(answered)::VARCHAR FROM traces""",
    "sessionize": "SELECT session_id, example_id AS trace_id, turn_no, request, response FROM examples",
    "metadata_literals": """SELECT conv_id, turn, CASE WHEN ok THEN 'conv-' || conv_id END AS session,
        CASE WHEN ok THEN text END AS note, CASE WHEN ok THEN turn END AS place,
        CASE WHEN ok THEN true END AS flag, CASE WHEN ok THEN conv_id END AS last,
        CASE WHEN ok THEN '{"flag":true,"list":[1,-2.5,' || conv_id || '],"none":null}' END AS "inner",
        NOT ok AS unreadable
        FROM (SELECT *, (conv_id + turn) % 7 <> 0 AS ok FROM conversations)""",
    "sessions_after_append": "SELECT session_id, example_id AS trace_id, turn_no, request, response FROM examples",
    "session_changes": """SELECT session_id, trace_id, turn_no, change FROM (
          SELECT session_id, example_id AS trace_id, turn_no, late, CASE WHEN late THEN 'added' ELSE 'replaced' END AS change,
            row_number() OVER (PARTITION BY session_id, late ORDER BY turn_no) AS old_no
          FROM (SELECT *, (split_part(example_id, '-', 2)::BIGINT * 1000 + split_part(example_id, '-', 3)::BIGINT) % 3 = 0 AS late
            FROM examples))
        WHERE late OR old_no <> turn_no""",
    "unroll_examples": """SELECT example_id, session_id, turn_no, 2 * turn_no - 1 AS n_messages,
        conversation_str, target_response FROM examples""",
    "unroll_examples_blocks": """SELECT example_id, session_id, turn_no,
        2 * turn_no - 1 AS n_messages, conversation_str, target_response FROM examples""",
    "unroll_examples_chain": """SELECT example_id, session_id, turn_no,
        2 * turn_no - 1 AS n_messages, conversation_str, target_response FROM examples""",
    "rendered_requests": f"""SELECT DISTINCT {_JUDGE_KEY} AS request_key,
        {_judge_user("conversation_str", "target_response")} AS prompt
        FROM scored WHERE quality_score IS NULL OR quality_score < 7""",
    "sessionize_range": """SELECT session_id, example_id AS trace_id, turn_no, request, response
        FROM examples""",
    "format_transcript": "SELECT example_id, conversation_str AS transcript FROM examples",
    "parse_transcript": _parsed("examples"),
    "last_user_message": "SELECT example_id, request AS user_input FROM examples",
    "messages_json": _parsed("examples"),
    "text_normalize": f"""SELECT doc_id, length({_strip("text")}) AS n_stripped,
        md5({_strip("text")}) AS stripped_md5, md5(lower({_strip("text")})) AS lower_md5,
        md5(upper(replace({_strip("text")}, 'ß', 'SS'))) AS upper_md5,
        contains(lower(text), 'license') AS has_license FROM documents""",
    "placeholder_flags": f"""
        SELECT doc_id, line, {_placeholder("text")} AS placeholder,
          {_placeholder("text", "[ \\t\\n\\x0b\\f\\r]+")} AS strict_placeholder
        FROM (SELECT doc_id, CAST(-1 AS BIGINT) AS line, text FROM documents
              UNION ALL
              SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT), unnest(lines)
              FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
    "length_budget": f"""SELECT doc_id, n_tokens, least(n_tokens, 2048) AS kept_tokens,
        n_tokens > 2048 AS over_budget FROM (SELECT doc_id, len({_TOKENS}) AS n_tokens FROM documents)""",
    "token_truncation": f"""SELECT doc_id, len(kept) AS n_tokens,
        md5(array_to_string(kept, ' ')) AS tokens_md5
        FROM (SELECT doc_id, {_TOKENS}[1:2048] AS kept FROM documents)""",
    "template_render": """SELECT trace_id, 'Asked:' || chr(10) || request || chr(10) || 'Answered ('
        || session_id || '):' || chr(10) || response || chr(10) AS rendered FROM turns""",
    "judge_requests": _messages(
        f"{_JUDGE_KEY} AS request_key, 'judge' AS stage, example_id, CAST(1024 AS BIGINT) AS max_tokens",
        "examples",
        P.JUDGE_SYSTEM,
        _judge_user("conversation_str", "target_response"),
    ),
    "dedupe_requests": f"""SELECT DISTINCT {_JUDGE_KEY} AS request_key, 'judge' AS stage,
        {_judge_user("conversation_str", "target_response")} AS prompt FROM examples""",
    "pending_requests": f"""SELECT DISTINCT {_JUDGE_KEY} AS request_key,
        {_judge_user("conversation_str", "target_response")} AS prompt
        FROM scored WHERE quality_score IS NULL OR quality_score < 7""",
    "attach_completions": "SELECT example_id, session_id, judge_content AS completion FROM judged",
    "judge_content": f"SELECT DISTINCT {_JUDGE_KEY} AS request_key, judge_content FROM judged",
    "parse_score": "SELECT example_id, quality_score FROM scored",
    "parse_reason": "SELECT example_id, judge_reason FROM scored",
    "scores_report": """SELECT session_id, conversation_str, target_response, quality_score,
        judge_reason, coalesce(quality_score >= 7, false) AS included FROM scored""",
    "curated_traces": """SELECT example_id, session_id, conversation_str,
        conversation_str AS messages_text, target_response, judge_content, quality_score,
        judge_reason FROM curated""",
    "generation_fanout": "SELECT example_id, CAST(i AS BIGINT) AS generation_idx FROM seeds",
    "generate_requests": _messages(
        f"{_GEN_KEY} AS request_key, 'generate' AS stage, example_id,"
        " CAST(i AS BIGINT) AS generation_idx, CAST(8192 AS BIGINT) AS max_tokens",
        "seeds",
        P.GENERATE_SYSTEM,
        _fill(
            P.GENERATE_USER,
            conversation_str="conversation_str",
            target_response="target_response",
        ),
    ),
    "parse_tags": """SELECT example_id, CAST(i AS BIGINT) AS generation_idx, generated_content,
        generated_request, generated_response FROM generated""",
    "synthetic_judge_input": "SELECT example_id, conversation_str, target_response FROM to_judge",
    "synthetic_judged": "SELECT example_id, judge_content, quality_score FROM rejudged",
    "synthetic_kept": """SELECT example_id, generated_request, generated_response, quality_score
        FROM kept""",
    "training_curated": "SELECT * FROM real_rows",
    "training_synthetic": "SELECT * FROM synthetic_rows",
    "synthetic_skipped": """SELECT example_id, reason, req AS request, res AS response
        FROM reasoned WHERE reason IS NOT NULL""",
    "training_data": "SELECT * FROM training",
    "training_csv_roundtrip": "SELECT source, input, output FROM training",
    "source_counts": "SELECT source, count(*) AS rows FROM training GROUP BY source",
    "stage_counts": """
        SELECT 'examples' AS stage, 'sessions' AS metric, count(DISTINCT session_id) AS value
        FROM examples
        UNION ALL SELECT 'examples', 'examples', count(*) FROM examples
        UNION ALL SELECT 'judge', 'judged', count(*) FROM scored
        UNION ALL SELECT 'judge', 'kept', count(*) FROM curated
        UNION ALL SELECT 'judge_synthetic', 'judged', count(*) FROM rejudged
        UNION ALL SELECT 'judge_synthetic', 'kept', count(*) FROM kept
        UNION ALL SELECT 'training', 'rows', count(*) FROM training
        UNION ALL SELECT 'training', 'skipped', count(*) FROM reasoned WHERE reason IS NOT NULL""",
    "holdout_split": "SELECT * FROM holdout",
    "trainval_split": "SELECT * FROM rest",
    "train_val_split": "SELECT example_id, split FROM assigned",
    "group_split": """
        SELECT example_id, session_id, CASE WHEN place <= round_even(CAST(0.1 AS DOUBLE) * n, 0)
          THEN 'holdout' ELSE 'train' END AS split
        FROM examples JOIN (
          SELECT session_id, row_number() OVER (ORDER BY md5(session_id || ':42'), session_id) AS place,
            count(*) OVER () AS n FROM (SELECT DISTINCT session_id FROM examples)) USING (session_id)""",
    "leak_free_split": """SELECT * FROM (
        WITH RECURSIVE sourced AS (
          SELECT t.example_id, split_part(t.example_id, '#', 1) AS seed_id, md5(t.input) AS input_hash, e.session_id
          FROM training t JOIN examples e ON e.example_id = split_part(t.example_id, '#', 1)),
        keyed AS (SELECT example_id, unnest(['s' || session_id, 'e' || seed_id, 'i' || input_hash]) AS value FROM sourced),
        firsts AS (SELECT value, min(example_id) AS hub FROM keyed GROUP BY value),
        edges AS (SELECT example_id AS a, hub AS b FROM keyed JOIN firsts USING (value)
          UNION SELECT hub, example_id FROM keyed JOIN firsts USING (value)),
        reach AS (SELECT example_id, example_id AS other FROM sourced
          UNION SELECT r.example_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
        parts AS (SELECT example_id, min(other) AS component FROM reach GROUP BY example_id),
        sizes AS (SELECT component, count(*) AS size FROM parts GROUP BY component),
        wanted AS (SELECT round_even(CAST(0.1 AS DOUBLE) * sum(size), 0) AS amount FROM sizes),
        held AS (SELECT component FROM (
          SELECT component, amount, sum(size) OVER (ORDER BY md5(component || ':42'), component) AS reached
          FROM sizes, wanted WHERE size <= amount) WHERE reached <= amount),
        left_over AS (SELECT * FROM sizes WHERE component NOT IN (SELECT component FROM held)),
        wanted_too AS (SELECT ceil(CAST(0.1 AS DOUBLE) * sum(size)) AS amount FROM left_over),
        checked AS (SELECT component FROM (
          SELECT component, amount, sum(size) OVER (ORDER BY md5(component || ':43'), component) AS reached
          FROM left_over, wanted_too WHERE size <= amount) WHERE reached <= amount)
        SELECT example_id, component, CASE WHEN component IN (SELECT component FROM held) THEN 'holdout'
          WHEN component IN (SELECT component FROM checked) THEN 'validation' ELSE 'train' END AS split FROM parts)""",
    "split_counts": """SELECT split, count(*) AS rows FROM (
        SELECT split FROM assigned UNION ALL SELECT 'holdout' FROM holdout) GROUP BY split""",
    "training_plan": """SELECT n AS train_rows, n // 8 AS steps_per_epoch,
        greatest(1, CAST(floor(CAST(0.1 AS DOUBLE) * (n // 8) * 3) AS BIGINT)) AS warmup_steps
        FROM (SELECT count(*) AS n FROM assigned WHERE split = 'train')""",
    "chat_text": f"""SELECT example_id, {_chat("input")} || '<|im_start|>assistant' || chr(10)
        || output || '<|im_end|>' || chr(10) AS text FROM assigned""",
    "holdout_roundtrip": "SELECT source, input, output FROM holdout",
    "chat_prompt": f"""SELECT example_id, {_chat("input")} || '<|im_start|>assistant' || chr(10)
        AS prompt FROM holdout""",
    "eval_results": "SELECT * FROM compared",
    "eval_requests": _parsed("holdout", "input", ", 'base' AS stage"),
    "eval_preview": """SELECT example_id, source, substr(user_input, 1, 120) AS user_input,
        substr(reference, 1, 120) AS reference, substr(base_response, 1, 120) AS base_response,
        substr(finetuned_response, 1, 120) AS finetuned_response,
        row_number() OVER (ORDER BY example_id) AS position, count(*) OVER () AS total
        FROM compared""",
    "prompt_corpus": "SELECT prompt_index, category, prompt FROM prompts",
    "prompt_requests": _messages(
        _copy_key(_key("seed", 1.0, 0, _SEED_SYSTEM, "prompt"), "prompt_index")
        + " AS request_key, 'seed' AS stage, prompt_index",
        "prompts",
        _SEED_SYSTEM,
        "prompt",
    ),
    "trace_tags": """
        SELECT prompt_index, 'run-1' AS session_id, printf('trace-%03d', prompt_index) AS run_name,
          'session_id' AS tag, 'run-1' AS value FROM prompts
        UNION ALL SELECT prompt_index, 'run-1', printf('trace-%03d', prompt_index),
          'prompt_index', prompt_index::VARCHAR FROM prompts""",
    "seed_traces": f"""SELECT 'run-1-' || prompt_index AS trace_id,
        printf('trace-%03d', prompt_index) AS run_name,
        CASE WHEN prompt LIKE '%?' THEN 'ERROR' ELSE 'OK' END AS state,
        {_strip("prompt")} AS request,
        CASE WHEN prompt LIKE '%?' THEN '' ELSE 'echo ' || md5(prompt) END AS response
        FROM prompts""",
    "seeded_turns": f"""SELECT 'run-1-' || prompt_index AS session_id,
        'run-1-' || prompt_index AS trace_id, prompt_index AS request_time_ms,
        {_strip("prompt")} AS request, 'echo ' || md5(prompt) AS response
        FROM prompts WHERE prompt NOT LIKE '%?'""",
    "seed_preview": """SELECT prompt_index, substr(prompt, 1, 80) AS prompt,
        CASE WHEN prompt NOT LIKE '%?' THEN 'echo ' || md5(prompt) END AS answer,
        prompt LIKE '%?' AS failed FROM prompts""",
}

ORACLES = {name: _sql(select) for name, select in _SELECTS.items()}
