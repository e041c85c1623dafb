"""DuckDB SQL for the registered queries, written apart from them."""

from __future__ import annotations

_TOKEN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"


def _count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{_TOKEN}'))"


_BLANKS = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_BLANKS}+', ''), '{_BLANKS}+$', '')"


FILES = """files AS (
  SELECT *, (CASE doc_id % 5 WHEN 0 THEN 'wiki/' WHEN 1 THEN 'sharepoint/' WHEN 2 THEN 'raw-documents/Wiki/' WHEN 3 THEN '' ELSE 'Documents/' END)
         || lang || '/' || source || '/doc_' || doc_id
         || (CASE doc_id % 7 WHEN 0 THEN '.md' WHEN 1 THEN '.txt' WHEN 2 THEN '.PDF' WHEN 3 THEN '.xlsx' WHEN 4 THEN '.docx' WHEN 5 THEN '.exe' ELSE '' END) AS path
  FROM documents
), named AS (
  SELECT *, regexp_extract(path, '([^/]*)$', 1) AS file_name, lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '^.*[^.].*(\\.[^.]*)$', 1)) AS ext FROM files
)"""

PAGES = f"""pages_ AS (
  SELECT conv_id AS doc, turn + 1 AS page, '[Page ' || (turn + 1) || ']' || chr(10) || {_strip("text")} AS label
  FROM conversations WHERE {_strip("coalesce(text, '')")} <> ''
), counted AS (
  SELECT *, {_count("label")}::BIGINT AS tokens, row_number() OVER (PARTITION BY doc ORDER BY page) AS i FROM pages_
)"""

PACKED = f"""RECURSIVE {PAGES}, walk AS (
  SELECT doc, i, page, label, tokens, 0 AS g, tokens AS total FROM counted WHERE i = 1
  UNION ALL
  SELECT c.doc, c.i, c.page, c.label, c.tokens, CASE WHEN w.total + c.tokens > 600 THEN w.g + 1 ELSE w.g END,
         CASE WHEN w.total + c.tokens > 600 THEN c.tokens ELSE w.total + c.tokens END
  FROM walk w JOIN counted c ON c.doc = w.doc AND c.i = w.i + 1
), packed AS (
  SELECT doc, g::BIGINT AS group_no, min(i)::BIGINT AS first_page, count(*) AS n_pages, sum(tokens)::BIGINT AS tokens,
         string_agg(label, chr(10) || chr(10) ORDER BY i) AS content
  FROM walk GROUP BY doc, g
)"""

NOTES = """notes AS (
  SELECT event_id, (CASE WHEN event_id % 11 = 0 THEN 'https://store/other/' ELSE 'https://store/raw-documents/' END) || event_type || '/u' || user_id || '/f' || event_id
         || (CASE event_id % 11 WHEN 1 THEN '.error.json' WHEN 2 THEN '/' WHEN 3 THEN '.exe' WHEN 4 THEN '.PDF' ELSE '.txt' END) AS url,
         CASE WHEN event_id % 13 <> 0 THEN floor(abs(value))::BIGINT END AS content_length
  FROM events
), judged AS (
  SELECT *, CASE WHEN instr(url, '/raw-documents/') > 0 THEN substr(url, instr(url, '/raw-documents/') + 15) END AS blob_path FROM notes
), admitted AS (
  SELECT *, CASE WHEN blob_path IS NULL THEN 'no_container' WHEN blob_path LIKE '%.error.json' THEN 'error_file'
                 WHEN coalesce(content_length, 0) = 0 THEN 'zero_bytes' WHEN blob_path LIKE '%/' THEN 'folder'
                 WHEN lower(regexp_extract(blob_path, '(\\.[a-zA-Z]*)$', 1)) NOT IN ('.txt', '.pdf') THEN 'extension' END AS reject_reason
  FROM judged
)"""

DESCRIBED = f"""{FILES}, described AS (
  SELECT n.*, coalesce(nullif(CASE l.quality WHEN 1 THEN 'curated' WHEN 0 THEN '' END, ''), CASE WHEN n.doc_id % 8 <> 0 THEN n.lang END) AS source_type,
         coalesce(CASE WHEN l.toxic = 1 THEN 'https://review/' || n.doc_id END, CASE WHEN n.doc_id % 9 <> 0 THEN 'https://docs/' || n.doc_id END) AS source_url
  FROM named n LEFT JOIN labels l USING (doc_id)
), reasoned AS (
  SELECT *, CASE WHEN coalesce(source_type, '') = '' THEN 'missing_source_type' WHEN coalesce(source_url, '') = '' THEN 'missing_source_url' END AS gate FROM described
)"""

BATCHED = f"""RECURSIVE pieces AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), sized AS (
  SELECT doc_id, i, {_count("coalesce(nullif(line, ''), '[empty]')")}::BIGINT AS n FROM pieces
), walk AS (
  SELECT doc_id, i, n, 0 AS b, n AS total, 1 AS k, n >= 200 AS shut FROM sized WHERE i = 1
  UNION ALL
  SELECT s.doc_id, s.i, s.n, CASE WHEN w.shut OR s.n >= 200 OR w.total + s.n > 200 OR w.k >= 16 THEN w.b + 1 ELSE w.b END,
         CASE WHEN w.shut OR s.n >= 200 OR w.total + s.n > 200 OR w.k >= 16 THEN s.n ELSE w.total + s.n END,
         CASE WHEN w.shut OR s.n >= 200 OR w.total + s.n > 200 OR w.k >= 16 THEN 1 ELSE w.k + 1 END, s.n >= 200
  FROM walk w JOIN sized s ON s.doc_id = w.doc_id AND s.i = w.i + 1
), batched AS (
  SELECT doc_id, b::BIGINT AS batch, min(i)::BIGINT AS first_chunk, count(*) AS n_chunks, sum(n)::BIGINT AS tokens FROM walk GROUP BY doc_id, b
)"""

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_PHONE = r"(?:\+[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
_CARD = "[0-9]{4}(?:[ -]?[0-9]{4}){3}"
_IBAN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}"


def _spans(kinds: list[tuple[str, str, float]], source: str, keys: str) -> str:
    """A row for each match: keys, kind, score, text, at (from 0)."""
    one = lambda kind, pattern, score: f"""
  SELECT {keys}, '{kind}' AS kind, {score}::DOUBLE AS score, m[i] AS found, (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS pos
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT {keys}, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM {source}))"""  # noqa: E731
    return " UNION ALL ".join(one(*k) for k in kinds)


_ALL = _spans([("Email", _EMAIL, 0.95), ("IPAddress", _IP, 0.9), ("PhoneNumber", _PHONE, 0.85), ("USSocialSecurityNumber", _SSN, 0.9), ("CreditCardNumber", _CARD, 0.95), ("InternationalBankingAccountNumber", _IBAN, 0.9)], "documents", "doc_id")

ENTITIES = f"""raw AS ({_ALL}
), luhn AS (
  SELECT *, list_reverse(list_transform(regexp_extract_all(found, '[0-9]'), lambda x: x::INTEGER)) AS ds FROM raw
), kept AS (
  SELECT * FROM luhn WHERE kind <> 'CreditCardNumber'
     OR list_sum(list_transform(range(1, len(ds) + 1), lambda i: CASE WHEN i % 2 = 1 THEN ds[i] WHEN ds[i] > 4 THEN 2 * ds[i] - 9 ELSE 2 * ds[i] END)) % 10 = 0
)"""

CUTS = """RECURSIVE long AS (
  SELECT doc_id, text FROM documents WHERE length(text) > 5120
), cut AS (
  SELECT doc_id, 0 AS piece, 0::BIGINT AS a, (CASE WHEN length(regexp_extract(text[1:5000], '(?s)^(.*) ', 1)) >= 1 THEN length(regexp_extract(text[1:5000], '(?s)^(.*) ', 1)) + 1 ELSE 5000 END)::BIGINT AS b, text FROM long
  UNION ALL
  SELECT doc_id, piece + 1, b, (CASE WHEN b + 5000 >= length(text) THEN length(text)
         WHEN length(regexp_extract(text[b + 1 : b + 5000], '(?s)^(.*) ', 1)) >= 1 THEN b + length(regexp_extract(text[b + 1 : b + 5000], '(?s)^(.*) ', 1)) + 1 ELSE b + 5000 END)::BIGINT, text
  FROM cut WHERE b < length(text)
), pieces AS (SELECT doc_id, piece::BIGINT AS piece, a, b, text[a + 1 : b] AS text FROM cut)"""

_SHEET = r"(?m)^Sheet:\s*(.+)$"

SQL: dict[str, str] = {
    "q01_page_pack_groups": f"WITH {PACKED} SELECT doc, group_no, first_page, n_pages, tokens FROM packed",
    "q02_page_labels": f"WITH {PAGES} SELECT doc, page::BIGINT AS page, label, tokens FROM counted",
    "q03_packed_chunk_records": f"""WITH {PACKED}
SELECT replace(replace(rtrim(to_base64(encode('wiki/chats/' || doc || '.pdf_' || group_no)), '='), '+', '-'), '/', '_') AS id, content AS chunk_content, doc || '.pdf' AS document_title,
       'chats > ' || doc || '.pdf' AS breadcrumb, group_no AS chunk_index, count(*) OVER (PARTITION BY doc) AS total_chunks, regexp_extract(content, '^\\[Page ([0-9]+)\\]', 1)::BIGINT AS page_number FROM packed""",
    "q04_chunk_counts_per_doc": f"WITH {PACKED} SELECT 'wiki/chats/' || doc || '.pdf' AS file_path, count(*) AS n_chunks, sum(length(content))::BIGINT AS n_chars FROM packed GROUP BY doc",
    "q05_chunk_ids": f"WITH {FILES} SELECT doc_id, replace(replace(rtrim(to_base64(encode(path || '_' || doc_id % 4)), '='), '+', '-'), '/', '_') AS id FROM files",
    "q06_breadcrumbs": f"""WITH {FILES}, p AS (SELECT doc_id, path, string_split(trim(replace(path, '\\', '/'), '/'), '/') AS s FROM files),
k AS (SELECT *, list_filter(range(1, len(s) + 1), lambda i: lower(s[i]) NOT IN ('raw-documents', 'wiki', 'sharepoint', 'documents'))[1] AS f FROM p)
SELECT doc_id, path, coalesce(array_to_string(s[f:], ' > '), path) AS breadcrumb FROM k""",
    "q07_admit_notifications": f"WITH {NOTES} SELECT event_id, blob_path, reject_reason FROM admitted",
    "q08_admission_reason_counts": f"WITH {NOTES} SELECT coalesce(reject_reason, 'admitted') AS reason, count(*) AS n, sum(coalesce(content_length, 0))::BIGINT AS bytes FROM admitted GROUP BY ALL",
    "q09_queue_envelope_unwrap": f"WITH {NOTES} SELECT event_id, url, content_length FROM notes UNION ALL SELECT event_id, url, content_length FROM notes WHERE event_id % 3 = 2",
    "q10_basename_ext": f"WITH {FILES} SELECT doc_id, file_name, ext FROM named",
    "q11_parser_route": f"""WITH {FILES} SELECT ext, CASE WHEN ext IN ('.md', '.txt', '.xlsx') THEN 'local' ELSE 'analyzer' END AS route,
CASE ext WHEN '.md' THEN 'markdown' WHEN '.txt' THEN 'text' WHEN '.xlsx' THEN 'xlsx' WHEN '.docx' THEN 'docx' WHEN '.pdf' THEN 'pdf' ELSE 'unsupported' END AS parser, count(*) AS n FROM named GROUP BY ALL""",
    "q12_chunk_strategy": f"WITH {FILES} SELECT doc_id, CASE ext WHEN '.md' THEN 'header_based' WHEN '.xlsx' THEN 'sheet_based' WHEN '.pdf' THEN 'semantic' ELSE 'recursive' END AS strategy FROM named",
    "q13_metadata_precedence": f"WITH {DESCRIBED} SELECT doc_id, source_type, source_url, gate AS reason FROM reasoned",
    "q14_embed_batches": f"WITH {BATCHED} SELECT * FROM batched",
    "q15_embed_batch_summary": f"WITH {BATCHED} SELECT n_chunks, count(*) AS n, max(tokens) AS most_tokens, sum(tokens)::BIGINT AS tokens FROM batched GROUP BY n_chunks",
    "q16_sanitise_truncate_flag": f"SELECT doc_id, n AS tokens, n > 500 AS truncated, least(n, 500)::BIGINT AS kept_tokens FROM (SELECT doc_id, {_count("coalesce(nullif(text, ''), '[empty]')")}::BIGINT AS n FROM documents)",
    "q17_fixed_tiling": """WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents)
SELECT doc_id, (i // 5)::BIGINT AS tile, count(*) AS n, sum(length(line))::BIGINT AS chars FROM l GROUP BY ALL""",
    "q18_redact_email": f"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_EMAIL}'))::BIGINT AS n_found, md5(regexp_replace(coalesce(text, ''), '{_EMAIL}', '[EMAIL REDACTED]', 'g')) AS redacted_md5 FROM documents",
    "q19_redact_multi_category": f"""SELECT doc_id, (len(regexp_extract_all(t, '{_EMAIL}')) + len(regexp_extract_all(t, '{_SSN}')) + len(regexp_extract_all(t, '{_IBAN}')))::BIGINT AS n_found,
md5(regexp_replace(regexp_replace(regexp_replace(t, '{_EMAIL}', '[EMAIL REDACTED]', 'g'), '{_SSN}', '[SSN REDACTED]', 'g'), '{_IBAN}', '[BANK ACCT REDACTED]', 'g')) AS redacted_md5
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "q20_pii_entity_report": f"WITH {ENTITIES} SELECT doc_id, kind AS entity_type, score, pos AS start_at, (pos + length(found))::BIGINT AS end_at, CASE WHEN length(found) > 20 THEN found[1:20] || '...' ELSE found END AS text_preview FROM kept",
    "q21_pii_category_counts": f"WITH {ENTITIES} SELECT kind AS entity_type, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM kept GROUP BY kind",
    "q22_threshold_allowlist": """WITH e AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Person' WHEN 1 THEN 'Email' ELSE 'Address' END AS category, (doc_id % 100) / 100.0::DOUBLE AS score,
         CASE WHEN doc_id % 3 = 0 THEN ['Merchant', 'Customer', 'Member', 'Borrower', 'Vendor', 'Applicant', 'Cardholder', 'Accountholder', 'Beneficiary', 'Guarantor', 'Co-signer'][doc_id % 11 + 1] ELSE source END AS text
  FROM documents)
SELECT doc_id, category, score::DOUBLE AS score, text, CASE category WHEN 'Email' THEN '[EMAIL REDACTED]' ELSE '[LOCATION REDACTED]' END AS label
FROM e WHERE category <> 'Person' AND score >= 0.8 AND doc_id % 3 <> 0""",
    "q23_long_text_cuts": f"WITH {CUTS} SELECT doc_id, piece, a AS start_at, b - a AS n_chars FROM pieces",
    "q24_long_cut_offsets": f"WITH {CUTS}, found AS ({_spans([('Email', _EMAIL, 0.95), ('IPAddress', _IP, 0.9)], 'pieces', 'doc_id, piece, a')}) SELECT doc_id, piece, kind AS category, a + pos AS start_at, length(found)::BIGINT AS n_chars FROM found",
    "q26_sheet_split": f"""WITH w AS (SELECT doc_id, 'junk' || chr(10) || 'Sheet: ' || lang || chr(10) || coalesce(text, '') || chr(10) || 'Sheet: none' || chr(10) || 'Sheet:  ' || source || ' ' || chr(10) || coalesce(text, '')[1:50] AS t FROM documents),
p AS (SELECT doc_id, regexp_extract_all(t, '{_SHEET}', 1) AS n, string_split_regex(t, '{_SHEET}') AS b FROM w),
u AS (SELECT doc_id, unnest(range(1, len(n) + 1)) AS i, n, b FROM p),
s AS (SELECT doc_id, i, {_strip("n[i]")} AS sheet, {_strip("b[i + 1]")} AS body FROM u)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::BIGINT AS sheet_index, sheet, length(body)::BIGINT AS n_chars, md5(body) AS body_md5 FROM s WHERE body <> ''""",
    "q27_section_paths": """WITH h AS (SELECT doc_id, list_transform(range(0, 7), lambda i: (doc_id * 7 + i * 5 + length(source) * i) % 4 + 1) AS lv FROM documents),
u AS (SELECT doc_id, lv, unnest(range(0, 7)) AS i FROM h),
j AS (SELECT u.doc_id, u.i, r.j FROM u, range(0, 7) r(j) WHERE r.j <= u.i AND (r.j = u.i OR len(list_filter(u.lv[r.j + 2 : u.i + 1], lambda x: x <= u.lv[r.j + 1])) = 0))
SELECT doc_id, i::BIGINT AS heading, string_agg('H' || j, ' > ' ORDER BY j) AS path FROM j GROUP BY doc_id, i""",
    "q28_table_linearise": """SELECT doc_id, array_to_string(list_transform(range(0, (len(w) + 2) // 3), lambda i: array_to_string(w[i * 3 + 1 : i * 3 + 3], ' | ')), chr(10)) AS table_text
FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)""",
    "q29_proportional_pages": """WITH p AS (SELECT doc_id, coalesce(text, '') AS t, doc_id % 5 + 1 AS n, unnest(range(0, doc_id % 5 + 1)) AS i FROM documents),
q AS (SELECT doc_id, i, CASE WHEN i < n - 1 THEN substr(t, i * greatest(1, length(t) // n) + 1, greatest(1, length(t) // n)) ELSE substr(t, i * greatest(1, length(t) // n) + 1) END AS page FROM p)
SELECT doc_id, i::BIGINT AS page, length(page)::BIGINT AS n_chars, md5(page) AS page_md5 FROM q""",
    "q30_span_pages": """SELECT doc_id, md5(array_to_string(list_transform(range(0, length(coalesce(text, '')) // 100 + 1), lambda i: CASE WHEN (doc_id + i * 31) % 120 > 10 THEN substr(coalesce(text, ''), i * 100 + 1, (doc_id + i * 31) % 120 - 10) ELSE '' END), '')) AS page_md5 FROM documents""",
    "q31_upsert_merge": """WITH o AS (SELECT vec_id, label::BIGINT AS label, len(embedding)::BIGINT AS dims, 'old' AS version FROM embeddings WHERE vec_id % 3 <> 0),
n AS (SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN label::BIGINT + 1000 END AS label, len(embedding)::BIGINT AS dims, 'new' AS version FROM embeddings WHERE vec_id % 3 = 0 OR vec_id % 2 = 0)
SELECT coalesce(n.vec_id, o.vec_id) AS vec_id, coalesce(n.label, o.label) AS label, coalesce(n.dims, o.dims) AS dims, coalesce(n.version, o.version) AS version FROM o FULL JOIN n ON o.vec_id = n.vec_id""",
    "q32_delete_document": f"WITH {FILES} SELECT doc_id, path AS file_path FROM files WHERE path NOT IN (SELECT path FROM files WHERE doc_id % 6 = 0)",
    "q33_orphan_delete_compat": """WITH r AS (SELECT doc_id, (CASE WHEN doc_id % 2 = 0 THEN 'wiki/' ELSE 'sharepoint/' END) || 'doc_' || doc_id // 2 || '.md' AS file_path FROM documents)
SELECT doc_id, file_path FROM r WHERE doc_id // 2 NOT IN (SELECT doc_id // 2 FROM r WHERE doc_id % 6 = 0)""",
    "q34_skip_null_vectors": "SELECT count(*) FILTER (vec_id % 10 <> 0) AS success, count(*) FILTER (vec_id % 10 = 0) AS skipped FROM embeddings",
    "q35_cosine_topk": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), p AS (
  SELECT q.vec_id AS query_id, v.vec_id AS id, list_cosine_similarity(v.e, q.e) AS score FROM v, v q WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM p)
SELECT query_id, rank, id, round_even(score, 5) AS score FROM r WHERE rank <= 5""",
    "q36_quantise_int8": """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
r AS (SELECT d, min(x) AS lo, max(x) AS hi FROM x GROUP BY d)
SELECT vec_id, string_agg(CASE WHEN hi > lo THEN (floor((x - lo) / (hi - lo) * 255 + 0.5) - 128)::INTEGER ELSE 0 END::VARCHAR, ',' ORDER BY d) AS codes FROM x JOIN r USING (d) GROUP BY vec_id""",
    "q37_stream_equals_batch": f"""WITH {FILES} SELECT ext, CASE WHEN coalesce(n_chars, 0) = 0 THEN 'zero_bytes' WHEN ext IN ('', '.exe') THEN 'extension' ELSE 'admitted' END AS reason, count(*) AS n FROM named GROUP BY ALL""",
    "q38_pii_policy_halt": f"WITH {FILES} SELECT path AS file_path, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n FROM files WHERE doc_id % 10 > 1",
    "q39_doc_status": f"""WITH {DESCRIBED}, s AS (SELECT *, CASE WHEN ext IN ('', '.exe') THEN '' ELSE text END AS full_text FROM reasoned),
t AS (SELECT *, CASE WHEN gate IS NOT NULL THEN gate WHEN ext = '.docx' THEN 'BadZipFile' WHEN {_strip("coalesce(full_text, '')")} = '' THEN 'no_text_extracted' WHEN doc_id % 12 = 0 THEN 'no_chunks_produced' END AS reason FROM s)
SELECT path AS file_path, CASE WHEN gate IS NULL AND ext = '.docx' THEN 'error' WHEN reason IS NULL THEN 'success' ELSE 'skipped' END AS status,
       CASE WHEN gate IS NULL AND ext = '.docx' THEN 'parse' END AS stage, reason, length(full_text)::BIGINT AS chars_extracted FROM t""",
    "q43_decode_lossy": """WITH b AS (SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN hex(encode(text)) || 'FF41' END AS h FROM documents),
d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN array_to_string(list_transform(range(0, length(h) // 2), lambda i: chr(('0x' || h[2 * i + 1 : 2 * i + 2])::INTEGER)), '') ELSE text END AS t FROM b)
SELECT doc_id, md5(coalesce(t, '')) AS text_md5, length(t)::BIGINT AS n_chars FROM d""",
    "q44_service_routes": f"""WITH {CUTS}, n AS (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id),
r AS (SELECT doc_id, CASE WHEN {_strip("coalesce(text, '')")} = '' THEN 'none' WHEN length(text) > 5120 THEN 'pieces' ELSE 'batch' END AS route FROM documents)
SELECT r.doc_id, route, CASE route WHEN 'none' THEN 0 WHEN 'pieces' THEN n.n ELSE 1 END::BIGINT AS n_pieces FROM r LEFT JOIN n ON n.doc_id = r.doc_id""",
    "q42_fold_runs": "SELECT doc_id, ceil(n / 7.0)::BIGINT AS runs, least(n, 7)::BIGINT AS longest FROM (SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents)",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
