"""DuckDB SQL for the operators that SQL can express.  The others are held against brute force in tests/llm."""

SQL: dict[str, str] = {}

SQL["op3_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""

SQL["op1_warc_chain"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


# Fixed values of the licence scan, written out here so that the SQL stands by itself.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
NOTICES = {
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-notice": "licensed under the apache license version 2 0",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
}


def _license_sql() -> str:
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in sorted(set(ws))) + "]"
    templates = " UNION ALL ".join(f"SELECT '{label}' AS label, {listed(notice.split())} AS ws" for label, notice in NOTICES.items())
    places = []
    for label, phrase in PHRASES.items():
        ws = phrase.split()
        match = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(ws))
        places.append(f"list_transform(list_filter(range(len(w)), lambda i: {match}), lambda i: struct_pack(at := i, label := '{label}'))")
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
w AS (SELECT doc_id, body, regexp_extract_all(body, '{WORD}') AS w FROM d),
p AS (SELECT doc_id, body, len(w) AS n_words, list_concat({", ".join(places[:2])}, list_concat({", ".join(places[2:])})) AS p FROM w),
t AS ({templates}),
l AS (SELECT doc_id, regexp_extract_all(unnest(string_split(body, chr(10))), '{WORD}') AS ws FROM d),
m AS (SELECT l.doc_id, t.label, len(list_intersect(t.ws, l.ws)) / len(t.ws) AS c FROM l, t WHERE len(list_intersect(t.ws, l.ws)) >= ceil(0.8 * len(t.ws) - 1e-9)),
h AS (SELECT doc_id, list(DISTINCT label) AS found, max(c) AS best FROM m GROUP BY doc_id)
SELECT p.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
       CAST(list_min(list_transform(p, lambda x: x.at)) AS BIGINT) AS first_word, CAST(list_max(list_transform(p, lambda x: x.at)) AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM p LEFT JOIN h USING (doc_id)
"""


SQL["op5_license_scan"] = _license_sql()

SQL["op6_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n AS p ON p.doc_id = a.doc_id JOIN n AS q ON q.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.y, c.r FROM c JOIN e ON e.x = c.doc_id WHERE c.r < e.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.r AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS r FROM c GROUP BY doc_id) AS m USING (doc_id)
"""
