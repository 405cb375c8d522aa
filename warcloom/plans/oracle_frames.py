"""The derived frames of frames.py, stated again as DuckDB SQL.

The two definitions are independent: the Spark side runs the library's own
parsers and classifiers where one exists, the SQL side states the expected
values from how each row was built.
"""

FRAMES: dict[str, str] = {}

FRAMES["fx_pages"] = r"""
SELECT page_id, url, host, lower(host) AS lhost,
       array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www[0-9]*\.', ''), '.')), ',') || ')'
       || CASE WHEN rtrim(pth, '/') = '' THEN '/' ELSE rtrim(pth, '/') END
       || CASE WHEN qry = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(qry, '&')), '&') END AS surt
FROM (SELECT page_id, url,
             regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host,
             lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)) AS pth,
             lower(regexp_extract(url, '\?([^#]*)', 1)) AS qry
      FROM pages)
"""

FRAMES["fx_log"] = r"""
SELECT event_id, user_id, value, ts,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp,
       CASE event_type WHEN 'view' THEN '200'
            WHEN 'click' THEN CASE WHEN m5 = 0 THEN '304' ELSE '200' END
            WHEN 'signup' THEN '302' WHEN 'purchase' THEN '404'
            ELSE CASE WHEN m5 = 0 THEN '-' ELSE '-5' END END AS status_code,
       CASE WHEN m5 = 4 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS content_length,
       CASE WHEN m11 = 0 THEN 'dns:' || page_host ELSE page_url END AS url,
       CASE m7 WHEN 0 THEN '-' WHEN 1 THEN 'LE' WHEN 2 THEN 'L' WHEN 3 THEN 'I' ELSE 'LLR' END AS hop_path,
       CASE WHEN m7 = 0 THEN '-' ELSE via_url END AS via,
       CASE WHEN m5 IN (0, 3) THEN 'text/html' WHEN m5 = 1 THEN 'application/pdf'
            WHEN m5 = 2 THEN 'image/png' ELSE 'unknown' END AS mime,
       '#0' AS thread,
       strftime(ts, '%Y%m%d%H%M%S') || '000+' || user_id AS start_time_plus_duration,
       strftime(ts, '%Y%m%d%H%M%S') AS start_ts,
       md5(page_url) AS hash,
       'tid:' || user_id || ':' || via_url AS source,
       CASE WHEN m5 = 3 THEN '-' ELSE 'ip:10.0.0.' || (user_id % 9)
            || CASE WHEN m11 = 3 THEN ',duplicate:digest' ELSE '' END
            || CASE WHEN m7 = 5 THEN ',3t' ELSE '' END
            || CASE WHEN m13 = 0 THEN ',launchTimestamp:' || strftime(ts, '%Y%m%d%H%M%S') ELSE '' END
            || CASE WHEN m13 = 5 THEN ',1: stream: Eicar-Test-Signature FOUND' ELSE '' END END AS annotation_string,
       CASE WHEN event_id % 2 = 0 THEN '{"warcFilename":"w' || (user_id % 20) || '.warc.gz"}'
            WHEN event_id % 10 = 1 THEN '{"warcPrefix":"wren-' || (user_id % 7) || '-"}' END AS extra_json,
       CASE WHEN m11 = 0 THEN 'dns:' || lower(page_host) ELSE page_surt END AS url_surt,
       CASE WHEN m7 = 0 THEN '-' ELSE via_surt END AS via_surt,
       page_lhost AS host
FROM (SELECT e.*, e.event_id % 5 AS m5, e.event_id % 7 AS m7, e.event_id % 11 AS m11, e.event_id % 13 AS m13,
             p.url AS page_url, p.host AS page_host, p.lhost AS page_lhost, p.surt AS page_surt,
             v.url AS via_url, v.surt AS via_surt
      FROM events e
      JOIN fx_pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
      JOIN fx_pages v ON v.page_id = (e.event_id + 1) % (SELECT count(*) FROM pages))
"""

FRAMES["fx_listing"] = r"""
SELECT CASE WHEN l_partkey % 97 = 0 THEN 'drwxr-xr-x' ELSE '-rw-r--r--' END AS permissions,
       1 + l_linenumber % 3 AS number_of_replicas, 'user' || (l_suppkey % 3) AS userid, 'archive' AS groupid,
       CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS filesize,
       l_shipdate + INTERVAL 36 HOUR AS modified_at,
       l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, k,
       strftime(l_shipdate, '%Y%m%d%H%M%S') AS d14, strftime(l_shipdate, '%Y%m%d') AS d8,
       CASE k
         WHEN 0 THEN '/heritrix/output/' || CASE WHEN l_linenumber % 2 = 0 THEN 'frequent-bypm' ELSE 'frequent-npld' END
              || '/' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '/warcs/BL-NPLD-'
              || strftime(l_shipdate, '%Y%m%d%H%M%S') || '123-' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') || '-h.warc.gz'
         WHEN 1 THEN '/heritrix/output/dc2024/' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '/logs/crawl.log.cp'
              || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') || '.gz'
         WHEN 2 THEN '/heritrix/output/warcs/dc' || (l_linenumber % 4) || '-' || strftime(l_shipdate, '%Y%m%d')
              || '/BL-' || l_partkey || '.warc.gz'
         WHEN 3 THEN '/data/' || l_partkey || '/' || l_suppkey || '/WARCS/f' || l_linenumber
              || CASE WHEN l_suppkey % 2 = 0 THEN '.warc.cdx' ELSE '.warc.gz' END
         WHEN 4 THEN '/1_data/bypm/webrecorder/job_' || (l_suppkey % 5) || '/warcs/x' || l_partkey || '.warc.gz.open'
         ELSE CASE l_partkey % 4
              WHEN 0 THEN '/_to_be_deleted/t' || l_partkey || '.tmp'
              WHEN 1 THEN '/heritrix/output/warcs/odd' || l_partkey
              WHEN 2 THEN '/user/ops/notes/n' || l_partkey || '.txt'
              ELSE '/heritrix/output/logs/weekly/' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '/alerts.log' END
       END AS filename
FROM (SELECT *, l_orderkey % 6 AS k FROM lineitem)
"""

FRAMES["fx_files"] = r"""
SELECT filename AS file_path, permissions, number_of_replicas, userid AS user_id, groupid AS group_id,
       filesize AS file_size, modified_at,
       string_split(filename, '/')[-1] AS file_name,
       CASE WHEN contains(string_split(filename, '/')[-1], '.')
            THEN substr(string_split(filename, '/')[-1], instr(string_split(filename, '/')[-1], '.')) END AS file_ext,
       NOT (k = 5 AND l_partkey % 4 IN (1, 2)) AS recognised,
       CASE k WHEN 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'bypm' ELSE 'npld' END WHEN 1 THEN 'npld' WHEN 2 THEN 'npld'
              WHEN 3 THEN 'selective' WHEN 4 THEN 'bypm'
              ELSE CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'heritrix' WHEN 2 THEN 'user' ELSE 'npld' END END AS collection,
       CASE k WHEN 0 THEN 'frequent' WHEN 1 THEN 'domain' WHEN 2 THEN 'domain' WHEN 3 THEN 'selective' WHEN 4 THEN 'webrecorder'
              ELSE CASE WHEN l_partkey % 4 = 3 THEN 'frequent' END END AS stream,
       CASE k WHEN 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'frequent-bypm' ELSE 'frequent-npld' END WHEN 1 THEN 'dc2024'
              WHEN 2 THEN 'dc' || substr(d8, 1, 4) WHEN 3 THEN CAST(l_partkey AS VARCHAR) WHEN 4 THEN 'job_' || (l_suppkey % 5)
              ELSE CASE WHEN l_partkey % 4 = 3 THEN 'weekly' END END AS job,
       CASE k WHEN 0 THEN d14 WHEN 1 THEN d14 WHEN 2 THEN d8 WHEN 3 THEN CAST(l_suppkey AS VARCHAR) WHEN 4 THEN NULL
              ELSE CASE WHEN l_partkey % 4 = 3 THEN d14 END END AS launch,
       CASE k WHEN 0 THEN 'npld-2018' WHEN 1 THEN 'npld-2018' WHEN 2 THEN 'npld-2013' WHEN 3 THEN 'wct' WHEN 4 THEN 'npld-2018-project'
              ELSE CASE WHEN l_partkey % 4 IN (1, 3) THEN 'npld-2013' END END AS layout,
       CASE k WHEN 0 THEN 'warcs' WHEN 1 THEN 'crawl-logs' WHEN 2 THEN 'warcs'
              WHEN 3 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'cdx' ELSE 'warcs' END WHEN 4 THEN 'warcs-invalid'
              ELSE CASE l_partkey % 4 WHEN 0 THEN 'to-be-deleted' WHEN 3 THEN 'logs' ELSE 'unknown' END END AS kind,
       CASE k WHEN 0 THEN l_shipdate + INTERVAL 123 MILLISECOND WHEN 2 THEN l_shipdate ELSE modified_at END AS file_ts,
       CASE k WHEN 0 THEN l_shipdate WHEN 1 THEN l_shipdate WHEN 2 THEN l_shipdate
              ELSE CASE WHEN k = 5 AND l_partkey % 4 = 3 THEN l_shipdate END END AS launch_datetime
FROM fx_listing WHERE permissions NOT LIKE 'd%'
"""

FRAMES["fx_targets"] = r"""
SELECT id, 'Site ' || upper(string_split(host, '.')[1]) || ' of ' || host AS title, host,
       CASE WHEN id % 2 = 0 THEN ['http://' || host || '/', 'http://' || host || '/en'] ELSE ['http://' || host || '/'] END AS seeds,
       CASE WHEN id % 17 = 4 THEN CAST([] AS VARCHAR[]) ELSE [first_url, 'http://' || string_split(host, '.')[1]
            || CASE id % 6 WHEN 0 THEN '.co.uk' WHEN 1 THEN '.scot' WHEN 2 THEN '.wales' WHEN 3 THEN '.london' WHEN 4 THEN '.cymru' ELSE '.info' END || '/'] END AS urls,
       id % 3 = 0 AS watched,
       CASE WHEN id % 11 = 5 THEN NULL ELSE CASE id % 4 WHEN 0 THEN 'root' WHEN 1 THEN 'subdomains' WHEN 2 THEN 'resource' ELSE 'plus1' END END AS scope,
       CASE id % 3 WHEN 0 THEN 'CAPPED' WHEN 1 THEN 'CAPPED_LARGE' ELSE 'DEEP' END AS depth,
       CASE WHEN id % 13 = 12 THEN NULL ELSE CASE id % 7 WHEN 0 THEN 'DAILY' WHEN 1 THEN 'WEEKLY' WHEN 2 THEN 'MONTHLY' WHEN 3 THEN 'QUARTERLY'
            WHEN 4 THEN 'SIXMONTHLY' WHEN 5 THEN 'ANNUAL' ELSE 'NEVERCRAWL' END END AS crawl_frequency,
       id % 2 = 0 AS is_oa,
       CASE WHEN id % 4 = 0 THEN ['295'] ELSE CAST([] AS VARCHAR[]) END AS license_ids,
       [id % 25, (id * 7) % 25] AS subject_ids,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(id % 60 AS INTEGER)) + to_hours(id % 3), '%Y-%m-%d %H:%M:%S') AS schedule_start,
       CASE WHEN id % 5 = 0 THEN '2024-03-01 00:00:00' END AS schedule_end,
       id % 5 = 0 AS ignore_robots,
       id % 2 = 1 AS uk_hosting, id % 3 = 1 AS uk_postal_address, id % 4 = 1 AS via_correspondence, id % 5 = 1 AS professional_judgement
FROM (SELECT lhost AS host, min(page_id) AS id, min(url) AS first_url FROM fx_pages GROUP BY lhost)
"""

FRAMES["fx_seeds"] = r"""
SELECT id, title, watched, is_oa, unnest(seeds) AS seed, generate_subscripts(seeds, 1) AS pos FROM fx_targets
"""

FRAMES["fx_seed_surts"] = r"""
SELECT *, array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(seed, '^http://([^/]+)', 1), '^www[0-9]*\.', ''), '.')), ',') || ')'
       || CASE WHEN seed LIKE '%/en' THEN '/en' ELSE '/' END AS seed_surt
FROM fx_seeds
"""

FRAMES["fx_collections"] = r"""
SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name, r_regionkey % 4 <> 3 AS publish,
       '2013-01-01' AS start_date, CAST(NULL AS VARCHAR) AS end_date FROM region
UNION ALL
SELECT 100 + n_nationkey, n_regionkey, n_name, n_nationkey % 4 <> 0, NULL,
       CASE WHEN n_nationkey % 2 = 0 THEN '2020-12-31' END FROM nation
UNION ALL
SELECT 10000 + s_suppkey, 100 + s_nationkey, s_name, s_suppkey % 3 <> 0, NULL, NULL FROM supplier
"""

FRAMES["fx_collection_targets"] = r"""
SELECT 100 + id % 25 AS collection_id, id AS target_id FROM fx_targets
UNION ALL SELECT id % 5, id FROM fx_targets
UNION ALL SELECT 10000 + s_suppkey, s_suppkey FROM supplier
"""

FRAMES["fx_subjects"] = r"""
SELECT CAST(n_nationkey AS BIGINT) AS id, 'About ' || n_name AS name, n_nationkey % 3 <> 0 AS publish FROM nation
"""

FRAMES["fx_cdx"] = r"""
SELECT CASE WHEN shot THEN 'screenshot:' || regexp_replace(lower(url), '#.*$', '') ELSE url_surt END AS urlkey,
       start_ts AS timestamp, CASE WHEN shot THEN 'screenshot:' || url ELSE url END AS original,
       CASE WHEN dup THEN 'warc/revisit' WHEN event_id % 6 = 0 THEN upper(mime) ELSE mime END AS mimetype,
       CASE WHEN dup THEN '-' ELSE status_code END AS statuscode,
       hash AS digest, '-' AS redirecturl, '-' AS robotflags, TRY_CAST(content_length AS BIGINT) AS length, event_id * 1000 AS "offset",
       '/heritrix/output/frequent-npld/20240101000000/warcs/w' || (user_id % 20) || '.warc.gz' AS filename, event_id, ts
FROM (SELECT *, event_id % 97 = 0 AND url LIKE 'http%' AS shot, annotation_string LIKE '%duplicate:digest%' AS dup FROM fx_log)
"""

FRAMES["fx_redirects"] = r"""
SELECT p.url, CASE WHEN p.page_id % 4 = 3 THEN substr(q.url, instr(q.url, '//')) ELSE q.url END AS location,
       CASE WHEN p.page_id % 4 = 3 THEN substr(p.url, 1, instr(p.url, '//') - 1) || substr(q.url, instr(q.url, '//')) ELSE q.url END AS resolved
FROM fx_pages p JOIN fx_pages q ON q.page_id = CASE WHEN p.page_id = 0 THEN 1 ELSE p.page_id // 2 END
"""

FRAMES["fx_launches"] = r"""
SELECT o_orderkey AS launch_no, p.url, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 173) % 2592000) AS launch_ts
FROM orders JOIN fx_pages p ON p.page_id = o_orderkey % (SELECT count(*) FROM pages)
"""

FRAMES["fx_watched_hits"] = r"""
SELECT l.* FROM fx_log l
WHERE EXISTS (SELECT 1 FROM fx_seed_surts s WHERE s.watched AND (starts_with(l.url_surt, s.seed_surt) OR starts_with(l.via_surt, s.seed_surt)))
"""

FRAMES["fx_candidates"] = r"""
SELECT * FROM fx_watched_hits
WHERE status_code LIKE '2__' AND mime = 'application/pdf' AND annotation_string NOT LIKE '%duplicate:digest%'
"""

FRAMES["fx_tracked"] = r"""
SELECT 'hdfs://' || file_path AS id, min(kind) AS kind_s, min(stream) AS stream_s, min(collection) AS collection_s, min(job) AS job_s,
       max(file_size) AS file_size_l, file_path AS file_path_s, min(file_name) AS file_name_s,
       max(modified_at) AS modified_at_dt, max(file_ts) AS timestamp_dt, year(max(file_ts)) AS year_i,
       CASE max(file_size) % 3 WHEN 0 THEN ['npld-cdx'] WHEN 1 THEN ['npld-cdx-v2', 'other'] END AS cdx_index_ss
FROM fx_files GROUP BY file_path
"""
