"""SQL that DuckDB runs over the same tables: the same results by a plainer path."""


def _norm(x: str) -> str:
    return rf"nullif(trim(regexp_replace(lower(strip_accents({x})), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '')"


def _compact(x: str) -> str:
    return rf"nullif(regexp_replace({_norm(x)}, '[^a-z0-9]+', '', 'g'), '')"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s ]+|[\s ]+$', '', 'g')".replace("\\u00a0", " ")


def _pieces(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, ';'), lambda t: {_strip('t')}), lambda t: t <> '')"


_UNBRACKETED = r"regexp_replace({}, '\([^()]*\)', ' ', 'g')"
_ORCID = r"nullif(upper(regexp_extract(coalesce(orcid, ''), '(?i)\d{4}-\d{4}-\d{4}-\d{3}[\dx]')), '')"
_MATCHED = "SELECT DISTINCT ON (person_id) * FROM person WHERE canonical_person_id IS NOT NULL"
_WORDS = rf"string_split(coalesce({_norm('text')}, ''), ' ')"
_RAW = _strip("coalesce(author_name_raw, '')")


def _int(x: str) -> str:
    return rf"CASE WHEN regexp_matches({_strip(f'CAST({x} AS VARCHAR)')}, '^[+-]?\d{{1,10}}$') THEN TRY_CAST({_strip(f'CAST({x} AS VARCHAR)')} AS INTEGER) END"


def _listed(x: str) -> str:
    """Distinct trimmed values between semicolons, sorted and joined; also of an array."""
    return f"array_to_string(list_sort(list_distinct({_pieces(x)})), '|')"


def _projection() -> str:
    from .projection import PUBLICATION_FIELDS

    arrays = ("research_areas", "web_of_science_index", "funding_orgs")
    cols = []
    for c, (_, kind) in PUBLICATION_FIELDS.items():
        source = f"array_to_string({c}, ';')" if c in arrays else c
        cols.append(f"{_int(c)} AS {c}" if kind == "int" else f"coalesce({_listed(source)}, '') AS {c}" if kind == "list" else c)
    known = " + ".join(f"({c} IS NOT NULL)::INT" for c in PUBLICATION_FIELDS)
    return f"""
        SELECT coalesce(nullif(doi, ''), nullif(ut_wos_id, ''), sha1(coalesce(title, '') || '|' || coalesce(CAST(nullif(publication_year, 0) AS VARCHAR), '') || '|' || coalesce(source_title, ''))) AS publication_id,
          {", ".join(cols)}, source_refs[1].source_file AS source_file, {known} AS n_keys, updated_at FROM publication"""


_NAMED = rf"""
        SELECT *, CASE WHEN contains(raw, ',') THEN {_strip("string_split(raw, ',')[1]")} ELSE string_split_regex(raw, '[\s ]+')[-1] END AS s,
          CASE WHEN contains(raw, ',') THEN {_strip("regexp_replace(raw, '^[^,]*,', '')")} ELSE array_to_string(string_split_regex(raw, '[\s ]+')[:-2], ' ') END AS g"""

_EDGES = """
edges_{p} AS (
  SELECT candidate_a_id AS a, candidate_b_id AS b FROM person_match_audit WHERE decision IN ({d}) AND candidate_a_id <> candidate_b_id
  UNION SELECT candidate_b_id, candidate_a_id FROM person_match_audit WHERE decision IN ({d}) AND candidate_a_id <> candidate_b_id
), walk_{p}(node, root) AS (
  SELECT a, a FROM edges_{p} UNION SELECT e.b, w.root FROM walk_{p} w JOIN edges_{p} e ON e.a = w.node WHERE w.root < e.b
), comp_{p} AS (SELECT node, min(root) AS component FROM walk_{p} GROUP BY node)"""
_FILES = """
SELECT r.source_file AS path, count(*) AS size, max(r.row_index) AS modified, sha1(CAST(sum(r.row_index) AS BIGINT)::VARCHAR) AS sha1
FROM (SELECT unnest(source_refs) AS r FROM person {w}) GROUP BY 1"""
_DIFF = f"""
SELECT coalesce(a.path, b.path) AS path, coalesce(a.size, b.size) AS size,
  CASE WHEN b.path IS NULL THEN 'new' WHEN a.path IS NULL THEN 'deleted' WHEN a.sha1 <> b.sha1 OR a.size <> b.size OR a.modified <> b.modified THEN 'changed' ELSE 'unchanged' END AS state
FROM ({_FILES.format(w='')}) a FULL JOIN ({_FILES.format(w='WHERE canonical_person_id IS NOT NULL')}) b USING (path)"""

ORACLES = {
    "search_and_range": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 1000 AND 400000
        AND o_orderdate >= TIMESTAMP '1995-01-01' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100""",
    "search_or_group": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_acctbal < 0",
    "search_not_in_missing": """SELECT person_id, country FROM person WHERE NOT coalesce(country IN ('China', 'United States', 'France'), false)
        AND NOT coalesce(orcid = '0000-0000-0000-0000', false)""",
    "search_prefix": """SELECT person_id, name_norm FROM person WHERE coalesce(starts_with(name_norm, 'al'), false)
        OR len(list_filter(coalesce(name_aliases, []), lambda x: starts_with(x, 'Al'))) > 0""",
    "search_match": f"SELECT doc_id, source FROM documents WHERE list_has_any({_WORDS}, ['interferometry', 'nanoindentation'])",
    "search_match_phrase": f"SELECT doc_id, source FROM documents WHERE contains(' ' || {_norm('text')} || ' ', ' remote sensing ')",
    "search_nested_same_element": """SELECT person_id, len(keywords) AS n_keywords FROM person WHERE len(keywords) > 0
        AND len(list_filter(source_refs, lambda r: r.source_system = 'scholars' AND r.row_index >= 20000)) > 0""",
    "search_offset_page": "SELECT event_id, event_type, value FROM events WHERE event_type IS NOT NULL ORDER BY value DESC NULLS LAST, event_id LIMIT 50 OFFSET 100",
    "search_after_page": """SELECT event_id, value FROM events WHERE value < 50.0 OR value IS NULL OR (value = 50.0 AND event_id > 100)
        ORDER BY value DESC NULLS LAST, event_id LIMIT 200""",
    "search_count": """SELECT count(*) AS total FROM publication WHERE publication_year BETWEEN 2005 AND 2015
        AND (doi IS NOT NULL OR NOT coalesce(language = 'English', false))""",
    "norm_text": f"SELECT doc_id, sha1({_norm('text')}) AS norm_sha1 FROM documents",
    "norm_compact": f"SELECT publication_id, {_compact('title')} AS compact FROM publication",
    "split_sorted": f"SELECT publication_id, coalesce(array_to_string(list_sort(list_distinct({_pieces('wos_categories')})), '|'), '') AS pieces FROM publication",
    "split_ordered": f"SELECT publication_id, coalesce(len({_pieces('author_keywords')}), 0) AS n, coalesce(array_to_string({_pieces('author_keywords')}, '|'), '') AS pieces FROM publication",
    "name_parts": rf"""
        WITH r AS (SELECT occurrence_id, {_RAW} AS raw FROM author_occurrence), p AS (
          SELECT *, CASE WHEN contains(raw, ',') THEN {_strip("string_split(raw, ',')[1]")} ELSE string_split_regex(raw, '[\s ]+')[-1] END AS s,
            CASE WHEN contains(raw, ',') THEN {_strip("regexp_replace(raw, '^[^,]*,', '')")} ELSE array_to_string(string_split_regex(raw, '[\s ]+')[:-2], ' ') END AS g
          FROM r)
        SELECT occurrence_id, CASE WHEN raw <> '' THEN {_norm('s')} END AS surname, CASE WHEN raw <> '' THEN {_norm('g')} END AS given,
          nullif(array_to_string(list_transform(list_filter(string_split(coalesce({_norm('g')}, ''), ' '), lambda t: t <> ''), lambda t: t[1]), ''), '') AS initials,
          {_compact('raw')} AS compact FROM p""",
    "email_extract": rf"""
        WITH e AS (SELECT person_id, list_filter(list_transform({_pieces('primary_email')}, lambda t: regexp_replace(t, '^\.+|\.+$', '', 'g')),
            lambda t: regexp_matches(t, '^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}$') AND NOT regexp_matches(t, '^\d+@'))[1] AS email FROM person)
        SELECT person_id, email, lower(string_split(email, '@')[1]) AS local_part, lower(string_split(email, '@')[2]) AS email_domain FROM e WHERE email IS NOT NULL""",
    "orcid_extract": f"SELECT person_id, {_ORCID} AS orcid FROM person WHERE {_ORCID} IS NOT NULL",
    "registrable_domain": r"""
        WITH a AS (SELECT primary_email AS address FROM person UNION ALL SELECT website FROM qs_university),
        h AS (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(address, '^[a-z][a-z0-9+.-]*://', ''), '^[^@/]*@', ''), '[/?#:].*$', ''), '^www\.', ''), '^\.+|\.+$', '', 'g') AS host
              FROM a WHERE regexp_matches(address, '^[a-z0-9:/._@-]+$')),
        l AS (SELECT list_filter(string_split(host, '.'), lambda t: t <> '') AS labels FROM h)
        SELECT CASE WHEN len(labels) >= 3 AND array_to_string(labels[-2:], '.') IN ('co.uk', 'ac.uk', 'com.cn', 'edu.cn', 'com.au', 'edu.au', 'co.jp', 'ac.jp') THEN array_to_string(labels[-3:], '.') ELSE array_to_string(labels[-2:], '.') END AS domain,
          count(*) AS n FROM l WHERE len(labels) >= 2 GROUP BY 1""",
    "coerce_rank": """SELECT qs_id, CAST(CASE WHEN regexp_matches(regexp_replace(trim(rank_text), '^=+\\s*', ''), '^\\d{1,9}$') THEN regexp_replace(trim(rank_text), '^=+\\s*', '') END AS INTEGER) AS rank,
        CASE WHEN regexp_matches(trim(rank_text), '^[+-]?\\d{1,10}$') THEN CAST(trim(rank_text) AS INTEGER) END AS plain, TRY_CAST(trim(score::VARCHAR) AS DOUBLE) AS score FROM qs_university""",
    "sha1_ids": """SELECT publication_id, sha1(coalesce(title, '') || '|' || coalesce(publication_year::VARCHAR, '') || '|' || coalesce(source_title, '')) AS hashed,
        coalesce(nullif(doi, ''), nullif(ut_wos_id, ''), sha1(coalesce(title, '') || '|' || coalesce(nullif(publication_year, 0)::VARCHAR, '') || '|' || coalesce(source_title, ''))) AS made_id FROM publication""",
    "stable_shard": "SELECT o_orderkey, CAST(('0x' || substr(sha1(o_orderkey::VARCHAR), 1, 12))::BIGINT % 16 AS INTEGER) AS shard FROM orders",
    "safe_bulk_id": "SELECT doc_id, CASE WHEN octet_length(encode(text)) > 512 THEN sha1(text) ELSE text END AS safe FROM documents",
    "sanitize_doc": f"SELECT doc_id, sha1(nullif({_strip(chr(39).join(['regexp_replace(text, ', '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', ', ', '', ', ', 'g', ')']))}, '')) AS clean_sha1 FROM documents",
    "first_wins": """SELECT publication_id, title, publication_year, count(*) OVER (PARTITION BY publication_id) - 1 AS n_later FROM publication
        QUALIFY row_number() OVER (PARTITION BY publication_id ORDER BY created_at, updated_at, title) = 1""",
    "coalesce_first": """
        SELECT canonical_person_id, first(orcid ORDER BY updated_at, person_id) FILTER (WHERE orcid IS NOT NULL) AS orcid, first(country ORDER BY updated_at, person_id) FILTER (WHERE country IS NOT NULL) AS country,
          first(name_original ORDER BY updated_at, person_id) AS name_original, min(qs_top200_rank) AS qs_top200_rank, bool_or(matched_by_orcid) AS matched_by_orcid, max(cluster_size) AS cluster_size, max(updated_at) AS updated_at
        FROM person WHERE canonical_person_id IS NOT NULL GROUP BY 1""",
    "max_score_best_decision": """
        SELECT least(candidate_a_id, candidate_b_id) AS a, greatest(candidate_a_id, candidate_b_id) AS b, max(score) AS score,
          arg_min(decision, CASE decision WHEN 'merge' THEN 0 WHEN 'manual_review' THEN 1 ELSE 2 END) AS decision FROM person_match_audit GROUP BY 1, 2""",
    "sorted_set_union": """SELECT canonical_person_id, coalesce(array_to_string(list_sort(list_distinct(flatten(list(keywords) FILTER (WHERE keywords IS NOT NULL)))), '|'), '') AS keywords
        FROM person WHERE canonical_person_id IS NOT NULL GROUP BY 1""",
    "ordered_union": f"""
        WITH k AS (SELECT canonical_person_id, updated_at, person_id, unnest(keywords) AS k, generate_subscripts(keywords, 1) AS pos FROM ({_MATCHED})),
        f AS (SELECT canonical_person_id, k, min(struct_pack(a := updated_at, b := person_id, c := pos)) AS seen FROM k GROUP BY 1, 2),
        j AS (SELECT canonical_person_id, string_agg(k, '|' ORDER BY seen) AS keywords FROM f GROUP BY 1)
        SELECT canonical_person_id, coalesce(keywords, '') AS keywords FROM (SELECT DISTINCT canonical_person_id FROM person WHERE canonical_person_id IS NOT NULL) LEFT JOIN j USING (canonical_person_id)""",
    "min_rank": "SELECT canonical_person_id, min(least(qs_top200_rank, world_top500_rank)) AS best_rank FROM person WHERE canonical_person_id IS NOT NULL GROUP BY 1",
    "representative": """
        SELECT canonical_person_id, person_id FROM (SELECT DISTINCT ON (person_id) *, CAST(list_contains(source_systems, 'scholars') AS INT) AS t,
            (orcid IS NOT NULL)::INT + (country IS NOT NULL)::INT + (current_affiliation IS NOT NULL)::INT + (primary_email IS NOT NULL)::INT + (h_index IS NOT NULL)::INT + (articles IS NOT NULL)::INT AS f
          FROM person WHERE canonical_person_id IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY canonical_person_id ORDER BY t DESC, f DESC, person_id DESC) = 1""",
    "mode_country": """
        WITH c AS (SELECT canonical_person_id, country, count(*) AS n, min(struct_pack(a := updated_at, b := person_id)) AS o FROM person
          WHERE canonical_person_id IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2)
        SELECT canonical_person_id, country FROM c QUALIFY row_number() OVER (PARTITION BY canonical_person_id ORDER BY n DESC, o) = 1""",
    "pk_conflicts": """
        WITH c AS (SELECT canonical_person_id,
            coalesce(first_value(country IGNORE NULLS) OVER w <> country, false) OR coalesce(first_value(orcid IGNORE NULLS) OVER w <> orcid, false) OR coalesce(first_value(h_index IGNORE NULLS) OVER w <> h_index, false) AS d
          FROM person WHERE canonical_person_id IS NOT NULL
          WINDOW w AS (PARTITION BY canonical_person_id ORDER BY updated_at, person_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT canonical_person_id, count(*) FILTER (WHERE d) AS n_conflicts FROM c GROUP BY 1 HAVING count(*) FILTER (WHERE d) > 0""",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS n_rows, count(*) FILTER (WHERE {t}) AS n_null, round(count(*) FILTER (WHERE {t}) / count(*), 6) AS null_rate, CAST(0 AS BIGINT) AS n_anomalies FROM person"
        for c, t in [
            *[(c, f"{c} IS NULL OR trim({c}) = ''") for c in ("orcid", "country", "current_affiliation", "primary_email")],
            ("keywords", "keywords IS NULL OR len(keywords) = 0"), ("h_index", "h_index IS NULL"), ("average_citations", "average_citations IS NULL"),
        ]
    ),
    "label_counts": """SELECT count(*) FILTER (WHERE decision = 'merge') AS merge_count, count(*) FILTER (WHERE decision = 'manual_review') AS manual_review_count,
        count(*) FILTER (WHERE decision = 'blocked_conflict') AS blocked_conflict_count FROM person_match_audit""",
    "known_counts": """SELECT 'qs_top200_rank' AS "column", count(qs_top200_rank) AS n_known FROM person UNION ALL SELECT 'world_top500_rank', count(world_top500_rank) FROM person
        UNION ALL SELECT 'orcid', count(orcid) FROM person""",
    "unique_lookup": """
        WITH a AS (SELECT DISTINCT ON (occurrence_id) * FROM author_occurrence WHERE surname_norm IS NOT NULL AND initials IS NOT NULL),
        k AS (SELECT publication_id, occurrence_id, 'i|' || surname_norm || '|' || initials AS key, 1 AS pr, 'surname_initials' AS rule FROM a
              UNION ALL SELECT publication_id, occurrence_id, 'f|' || surname_norm || '|' || initials[1], 2, 'surname_first_initial' FROM a),
        u AS (SELECT publication_id, key, min(occurrence_id) AS owner_id FROM k GROUP BY 1, 2 HAVING count(DISTINCT occurrence_id) = 1)
        SELECT k.publication_id, k.occurrence_id AS asked_id, u.owner_id, k.rule FROM k JOIN u USING (publication_id, key)
        QUALIFY row_number() OVER (PARTITION BY k.publication_id, k.occurrence_id ORDER BY pr) = 1""",
    "ranked_alias_lookup": rf"""
        WITH q AS (SELECT {_norm(_UNBRACKETED.format('university'))} AS alias, country AS c, CAST(regexp_replace(rank_text, '^=+', '') AS INTEGER) AS r FROM qs_university),
        p AS (SELECT DISTINCT ON (person_id) person_id, CASE WHEN country IN (SELECT country FROM qs_university) THEN country END AS country, current_affiliation AS f FROM person WHERE current_affiliation IS NOT NULL),
        a AS (SELECT person_id, country, 1 AS pos, {_norm('f')} AS alias FROM p UNION ALL SELECT person_id, country, 2, {_norm(_UNBRACKETED.format('f'))} FROM p
              UNION ALL SELECT person_id, country, 3, {_norm("string_split(f, ',')[1]")} FROM p),
        h AS (SELECT person_id, pos, country, min(r) FILTER (WHERE c = country) AS same, min(r) AS anyr, count(DISTINCT c) AS n FROM a JOIN q USING (alias) GROUP BY ALL),
        b AS (SELECT person_id, CASE WHEN country IS NOT NULL THEN same WHEN n = 1 THEN anyr END AS rank FROM h QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY pos) = 1)
        SELECT person_id, rank FROM b WHERE rank IS NOT NULL""",
    "domain_lookup": r"""
        WITH q AS (SELECT domain AS email_domain, min(CAST(regexp_replace(rank_text, '^=+', '') AS INTEGER)) AS rank FROM qs_university GROUP BY 1)
        SELECT person_id, email_domain, rank FROM (SELECT DISTINCT person_id, nullif(lower(regexp_extract(coalesce(primary_email, ''), '@([^@]*)$', 1)), '') AS email_domain FROM person) JOIN q USING (email_domain)""",
    "lookup_with_synthesis": """
        WITH a AS (SELECT DISTINCT ON (occurrence_id) occurrence_id, author_name_norm AS name FROM author_occurrence WHERE is_corresponding_author),
        p AS (SELECT DISTINCT ON (person_id) person_id, name_norm FROM person)
        SELECT occurrence_id, name, coalesce(person_id, sha1(coalesce(name, '') || '||')) AS person_id, person_id IS NULL AS is_made FROM a LEFT JOIN p ON name_norm = name""",
    "cascade_lookup": """
        WITH i AS (SELECT publication_id, min(title) AS t FROM publication GROUP BY 1), w AS (SELECT ut_wos_id, min(title) AS t FROM publication WHERE ut_wos_id IS NOT NULL GROUP BY 1)
        SELECT doc_id, coalesce(i.t, w.t) AS matched_title FROM documents d LEFT JOIN i ON d.publication_id = i.publication_id LEFT JOIN w ON d.publication_id = w.ut_wos_id WHERE coalesce(i.t, w.t) IS NOT NULL""",
    "margin_top1": """
        WITH s AS (SELECT user_id, event_type, round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 6) AS score FROM events GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER w AS r, coalesce(lead(score) OVER w, 0) AS nx FROM s WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, event_type DESC))
        SELECT user_id, event_type, score FROM r WHERE r = 1 AND score >= 0.2 AND (score - nx >= 0.02 OR score >= 0.4)""",
    "star_edges": f"""
        WITH k AS (SELECT DISTINCT person_id, {_ORCID} AS key FROM person), m AS (SELECT key, min(person_id) AS a FROM k WHERE key IS NOT NULL GROUP BY 1)
        SELECT DISTINCT a, person_id AS b FROM k JOIN m USING (key) WHERE a <> person_id""",
    "blocked_pairs": f"""
        WITH k AS (SELECT DISTINCT person_id AS node, 'n|' || name_norm AS key FROM person WHERE name_norm IS NOT NULL UNION SELECT DISTINCT person_id, 'o|' || {_ORCID} FROM person WHERE {_ORCID} IS NOT NULL),
        u AS (SELECT * FROM k WHERE key IN (SELECT key FROM k GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50))
        SELECT l.node AS a, r.node AS b, string_agg(DISTINCT l.key, ',' ORDER BY l.key) AS keys FROM u l JOIN u r ON l.key = r.key AND l.node < r.node GROUP BY 1, 2""",
    "components": f"WITH RECURSIVE {_EDGES.format(p='m', d=chr(39) + 'merge' + chr(39))} SELECT node, component FROM comp_m",
    "phased_merges": f"""
        WITH RECURSIVE {_EDGES.format(p='m', d="'merge'")}, {_EDGES.format(p='r', d="'merge', 'manual_review'")},
        n AS (SELECT count(*) AS t FROM (SELECT person_id FROM person UNION SELECT candidate_a_id FROM person_match_audit UNION SELECT candidate_b_id FROM person_match_audit)),
        c AS (SELECT (SELECT t FROM n) - (SELECT count(*) - count(DISTINCT component) FROM comp_m) AS one, (SELECT t FROM n) - (SELECT count(*) - count(DISTINCT component) FROM comp_r) AS two)
        SELECT 'merge' AS phase, (SELECT t FROM n) - one AS merges FROM c UNION ALL SELECT 'manual_review', one - two FROM c""",
    "remap_relations": """
        WITH p AS (SELECT name_norm, min(canonical_person_id) AS c FROM person WHERE canonical_person_id IS NOT NULL AND name_norm IS NOT NULL GROUP BY 1),
        r AS (SELECT c, publication_id, min(author_order) AS author_order FROM author_occurrence JOIN p ON author_name_norm = name_norm GROUP BY 1, 2)
        SELECT sha1(c || '|' || publication_id || '|author') AS relation_id, c AS canonical_person_id, publication_id, author_order FROM r""",
    "reconcile_orcid": f"""
        WITH p AS (SELECT DISTINCT ON (person_id) person_id, {_ORCID} AS orcid, country, h_index, matched_by_orcid, updated_at FROM person),
        r AS (SELECT orcid, person_id AS i FROM p WHERE orcid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY orcid ORDER BY (country IS NOT NULL)::INT + (h_index IS NOT NULL)::INT DESC, person_id DESC) = 1),
        m AS (SELECT p.*, coalesce(r.i, p.person_id) AS i FROM p LEFT JOIN r ON p.orcid = r.orcid)
        SELECT i AS person_id, first(orcid ORDER BY updated_at, person_id) FILTER (WHERE orcid IS NOT NULL) AS orcid, first(country ORDER BY updated_at, person_id) FILTER (WHERE country IS NOT NULL) AS country,
          bool_or(matched_by_orcid) AS matched_by_orcid, max(updated_at) AS updated_at FROM m GROUP BY i""",
    "inferred_scores": """
        WITH s AS (SELECT candidate_a_id, candidate_b_id, least(greatest(coalesce(CASE WHEN decision = 'merge' THEN score END, 0.55::DOUBLE + CASE WHEN list_contains(rules_hit, 'name_compact') THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN list_contains(rules_hit, 'shared_institution') THEN 0.1::DOUBLE ELSE 0 END), 0), 1) AS s FROM person_match_audit)
        SELECT candidate_a_id, candidate_b_id, round(s, 6) AS match_score, CASE WHEN s >= 0.85 THEN 'high' WHEN s >= 0.65 THEN 'medium' ELSE 'low' END AS confidence FROM s""",
    "exact_knn": """
        WITH s AS (SELECT q.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS c FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, vec_id, round(c, 4) AS cosine FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) <= 10""",
    "vector_left_join": "SELECT doc_id, coalesce(len(embedding) = 64, false) AS has_vector FROM documents LEFT JOIN embeddings ON vec_id = doc_id",
    "anchor_pick": """
        WITH p AS (SELECT publication_id, max(publication_year) AS y, max(times_cited_wos_core) AS t FROM publication GROUP BY 1),
        a AS (SELECT DISTINCT occurrence_id, publication_id, author_order, author_name_norm, is_corresponding_author FROM author_occurrence WHERE author_name_norm IS NOT NULL)
        SELECT author_name_norm, occurrence_id, count(*) OVER (PARTITION BY author_name_norm) AS n_evidences FROM a JOIN p USING (publication_id)
        QUALIFY row_number() OVER (PARTITION BY author_name_norm ORDER BY coalesce(is_corresponding_author, false) DESC, coalesce(author_order, 1000000000), coalesce(y, 0) DESC, coalesce(t, 0) DESC, occurrence_id) = 1""",
    "contact_group": f"""
        SELECT lower({_strip('primary_email')}) || '|' || lower({_strip("coalesce(name_norm, '')")}) AS contact, count(*) AS n, min(person_id) AS first_id
        FROM (SELECT DISTINCT ON (person_id) * FROM person WHERE primary_email IS NOT NULL) GROUP BY 1""",
    "export_flat": """SELECT person_id, nullif(array_to_string(keywords, '；'), '') AS keywords, CASE WHEN matched_by_orcid THEN '是' WHEN NOT matched_by_orcid THEN '否' END AS matched_by_orcid,
        h_index::VARCHAR AS h_index FROM person""",
    "manifest_diff": _DIFF,
    "enqueue_idempotent": f"SELECT path, 'silver' AS stage FROM ({_DIFF}) WHERE state IN ('new', 'changed')",
    "stream_upsert": """WITH k AS (SELECT *, coalesce(title, '') || chr(1) || coalesce(CAST(publication_year AS VARCHAR), '') AS ok FROM publication)
        SELECT publication_id, arg_min(title, (created_at, ok)) FILTER (title IS NOT NULL) AS title, arg_min(publication_year, (created_at, ok)) FILTER (publication_year IS NOT NULL) AS publication_year,
        max(times_cited_wos_core) AS times_cited_wos_core, min(created_at) AS created_at, max(updated_at) AS updated_at FROM k GROUP BY publication_id""",
    "publication_projection": _projection(),
    "person_seeds": f"""
        WITH p AS (SELECT *, {_norm('name_original')} AS n, {_ORCID} AS o FROM person WHERE list_contains(source_systems, 'scholars'))
        SELECT sha1(n || '|' || coalesce(o, '') || '|' || coalesce(country, '')) AS person_id, n AS name_norm, o AS orcid, country, current_affiliation,
          coalesce({_listed("array_to_string(subjects, ';')")}, '') AS subjects, h_index, total_citations, articles, CASE WHEN country IS NULL THEN 0 ELSE 1 END AS n_countries, updated_at
        FROM p WHERE n IS NOT NULL""",
    "publication_stability": f"""
        WITH p AS (SELECT publication_id, min(source_title) AS t FROM publication WHERE source_title IS NOT NULL GROUP BY 1),
        a AS (SELECT DISTINCT ON (occurrence_id) * FROM author_occurrence)
        SELECT {_compact('author_name_norm')} || '|' || t AS key, count(DISTINCT publication_id) AS n_publications, count(*) AS n_nodes FROM a JOIN p USING (publication_id)
        WHERE is_corresponding_author AND {_compact('author_name_norm')} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT publication_id) > 1""",
    "author_rows": rf"""
        WITH a AS (SELECT DISTINCT ON (occurrence_id) publication_id, author_order, author_name_raw FROM author_occurrence),
        l AS (SELECT publication_id, list_filter(list_transform(string_split(string_agg(author_name_raw, '; ' ORDER BY author_order NULLS FIRST, author_name_raw NULLS FIRST), ';'), lambda t: {_strip('t')}), lambda t: t <> '') AS names FROM a GROUP BY 1),
        e AS (SELECT publication_id, unnest(names) AS raw, generate_subscripts(names, 1) AS author_order FROM l), h AS ({_NAMED} FROM e)
        SELECT publication_id, CAST(author_order AS INTEGER) AS author_order, {_norm('raw')} AS author_name_norm, {_norm('s')} AS surname_norm,
          nullif(array_to_string(list_transform(list_filter(string_split(coalesce({_norm('g')}, ''), ' '), lambda t: t <> ''), lambda t: t[1]), ''), '') AS initials FROM h WHERE {_norm('raw')} IS NOT NULL""",
    "type_anomalies": " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS n_rows, count(*) FILTER ({c} IS NULL OR trim({c}, ' ') = '') AS n_null, round(count(*) FILTER ({c} IS NULL OR trim({c}, ' ') = '') / count(*), 6) AS null_rate, "
        f"count(*) FILTER ({c} IS NOT NULL AND NOT regexp_matches({c}, '^\\s*[+-]?\\d{{1,{9 if c != 'pubmed_id' else 18}}}(\\.\\d*)?\\s*$')) AS n_anomalies FROM publication"
        for c in ("volume", "issue", "pubmed_id")
    ),
    "embed_text": f"""
        WITH t AS (SELECT publication_id, nullif({_strip('title')}, '') AS t, nullif({_strip('abstract')}, '') AS a, nullif({_strip('author_keywords')}, '') AS k, nullif({_strip('keywords_plus')}, '') AS q FROM publication)
        SELECT publication_id, CASE WHEN t IS NOT NULL THEN concat_ws(chr(10), 'Title: ' || t, 'Abstract: ' || a, 'Author keywords: ' || k, 'Keywords plus: ' || q) END AS embedding_text FROM t""",
}
