"""Independent SQL for the registered queries, in DuckDB's dialect.

The SQL is phrased from the meaning of each query (joins on per-id tables,
regular-expression matches, unnested ranges, pair-wise products), not from the
Spark plans.
"""

from __future__ import annotations

from foliograph.checks.queries import (
    CODED_DEPTH,
    DEEP_OFFSET,
    FILTER_CATEGORIES,
    LETTERS,
    NEIGHBOURS,
    OLD_CHUNKS,
    PAGE_AFTER,
    PAGE_LIMIT,
    PAGE_OFFSET,
    PROBED_TENTHS,
    REFUSED,
    SAMPLE_FRAC,
    SAMPLE_SIZE,
    SEED,
)
from foliograph.operators.approximate import BITS, DEPTH
from foliograph.operators.inverted_file import ROUNDS, SCALE, STEPS

_RAW_COLUMNS = (
    "arxiv_id, title, abstract, authors, categories, primary_category, "
    "submitted, updated, journal_ref, doi, comment"
)

# Each step names the steps it reads from.
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def _step(name: str, needs: tuple[str, ...], sql: str) -> None:
    _STEPS[name] = (needs, sql)


def _query(final: str, *needs: str) -> str:
    """``final`` with the steps it needs, and theirs, as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for earlier in _STEPS[name][0]:
            visit(earlier)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    return "with " + ",\n".join(f"{n} as ({_STEPS[n][1]})" for n in ordered) + "\n" + final


_step("raw", (), """
    select cast(doc_id - case when doc_id % 10 = 9 then 1 else 0 end as varchar) as arxiv_id,
           case when doc_id % 29 = 0 then ' ' else substr(text, 1, 60) end as title,
           case when doc_id % 31 = 0 then null else text end as abstract,
           case when doc_id % 37 = 0 then ' , '
                when doc_id % 41 = 0 then ', Author 0'
                else 'Author ' || cast(doc_id % 43 as varchar)
                     || case when doc_id % 2 = 0
                             then ', Author ' || cast((doc_id * 7) % 53 as varchar) else '' end
           end as authors,
           lang || '.' || source || '  x.' || cast(doc_id % 3 as varchar) as categories,
           lang || '.' || source as primary_category,
           case when doc_id % 23 = 0 then '2007-04-02'
                when doc_id % 47 = 0 then 'Mon, 2 Apr 2010x z'
                else 'Mon,  2 Apr ' || cast(2007 + doc_id % 17 as varchar) || ' 19:18:42 GMT'
           end as submitted,
           cast(2015 + doc_id % 5 as varchar) || '-01-01' as updated,
           case when doc_id % 3 = 0 then source end as journal_ref,
           cast(null as varchar) as doi,
           cast(null as varchar) as comment
    from documents""")

_step("base", ("raw",), """
    select trim(arxiv_id) as arxiv_id,
           coalesce(trim(title), '') as title, coalesce(trim(abstract), '') as abstract,
           coalesce(trim(authors), '') as authors,
           coalesce(trim(primary_category), '') as primary_category,
           coalesce(trim(submitted), '') as submitted, coalesce(trim(updated), '') as updated,
           coalesce(trim(journal_ref), '') as journal_ref, coalesce(trim(doi), '') as doi,
           coalesce(trim(comment), '') as comment
    from raw where trim(arxiv_id) <> ''""")

_step("unique_papers", ("base",), """
    select * from base
    where title <> '' and abstract <> '' and authors <> ''
      and primary_category <> '' and submitted <> ''
    qualify row_number() over (
        partition by arxiv_id
        order by submitted desc, updated desc, title, primary_category, journal_ref,
                 doi, comment, authors, abstract) = 1""")

_step("years", ("unique_papers",), """
    select arxiv_id, submitted,
           coalesce(try_cast(regexp_extract(token, '^[+-]?[0-9]+') as bigint), 0) as submitted_year
    from (select arxiv_id, submitted,
                 regexp_extract(submitted, '^ *[^ ]+ +[^ ]+ +[^ ]+ +([^ ]+)', 1) as token
          from unique_papers)
    where token <> ''""")

_step("word_counts", ("unique_papers",), r"""
    select arxiv_id,
           cast(len(regexp_extract_all(abstract, '[^ \r\n\t]+')) as bigint) as abstract_word_count
    from unique_papers""")

_step("names", ("unique_papers",), """
    select arxiv_id, trim(name) as author
    from (select arxiv_id, unnest(string_split(authors, ',')) as name from unique_papers)
    where trim(name) <> ''""")

_step("name_counts", ("names",), """
    select arxiv_id, count(*) as author_count from names group by arxiv_id""")

_step("papers", ("unique_papers", "years", "word_counts", "name_counts"), """
    select u.arxiv_id, u.title, u.abstract, u.authors, u.primary_category, u.submitted,
           w.abstract_word_count, n.author_count,
           trim(string_split(u.authors, ',')[1]) as first_author,
           y.submitted_year,
           string_split(u.primary_category, '.')[1] as subject_area,
           case when u.journal_ref = '' then 'unpublished' else 'published' end as pub_status
    from unique_papers u
    join years y using (arxiv_id)
    join word_counts w using (arxiv_id)
    join name_counts n using (arxiv_id)""")

_step("paper_names", ("papers", "names"), """
    select arxiv_id, n.author, p.primary_category, p.submitted_year
    from papers p join names n using (arxiv_id)""")

_step("name_categories", ("paper_names",), """
    select author, primary_category as category, count(*) as category_count
    from paper_names group by all""")

_step("name_tops", ("name_categories",), """
    select author, category as top_category from name_categories
    qualify row_number() over (partition by author order by category_count desc, category) = 1""")

_step("top5", ("papers",), """
    select primary_category as category, count(*) as paper_count from papers
    group by all order by paper_count desc, category limit 5""")

_step("grouped", ("papers", "top5"), """
    select p.*, coalesce(t.category, 'Other') as category_group
    from papers p left join top5 t on p.primary_category = t.category""")

_step("edges", ("grouped",), """
    select category_group, lo, hi, total, i, lo + i * ((hi - lo) / 30.0::double) as left_edge,
           case when i = 29 then hi else lo + (i + 1) * ((hi - lo) / 30.0::double) end as right_edge
    from (select category_group, count(*) as total,
                 min(abstract_word_count)
                   - case when min(abstract_word_count) = max(abstract_word_count) then 0.5::double
                          else 0::double end as lo,
                 max(abstract_word_count)
                   + case when min(abstract_word_count) = max(abstract_word_count) then 0.5::double
                          else 0::double end as hi
          from grouped group by category_group), range(30) r(i)""")

_step("eligible", ("papers",), r"""
    select arxiv_id, regexp_replace(title, '^\s+|\s+$', '', 'g') as title,
           regexp_replace(abstract, '^\s+|\s+$', '', 'g') as abstract, primary_category as category,
           submitted_year as year,
           case pub_status when 'published' then 'Published' else 'Preprint' end as pub_status,
           first_author
    from papers
    where first_author <> '' and regexp_matches(title, '\S') and primary_category <> ''
      and regexp_matches(abstract, '\S')""")


def _chunk_step(name: str, source: str, size: int, overlap: int) -> None:
    step = size - overlap
    _step(name, (source,), rf"""
    select arxiv_id || ':' || cast(i as varchar) as chunk_id, i as chunk_idx,
           array_to_string(list_slice(words, i * {step} + 1, i * {step} + {size}), ' ') as chunk_text,
           arxiv_id, title, category, year, pub_status, first_author
    from (select *, unnest(range(len(words))) as i
          from (select *, regexp_extract_all(abstract, '\S+') as words from {source}))
    where i = 0 or (i - 1) * {step} + {size} < len(words)""")


_chunk_step("chunk", "eligible", 200, 40)
_step("old_papers", ("eligible",), "select * from eligible where pub_status = 'Published'")
_chunk_step("old_chunk", "old_papers", *OLD_CHUNKS)

_BUCKET = """cast(('0x' || substr(md5(token), 7, 2) || substr(md5(token), 5, 2)
           || substr(md5(token), 3, 2) || substr(md5(token), 1, 2)) as bigint) % 384"""

_step("chunk_tf", ("chunk",), rf"""
    select chunk_id, {_BUCKET} as bucket, cast(count(*) as bigint) as tf
    from (select chunk_id, unnest(regexp_extract_all(lower(chunk_text), '\S+')) as token from chunk)
    group by all""")

_step("chunk_norm", ("chunk_tf",), """
    select chunk_id, cast(sum(tf * tf) as bigint) as squares from chunk_tf group by chunk_id""")

_step("question", (), """
    select item_id as question_id, trim(text) as question,
           case when item_id % 3 = 0 then 'en.src' || cast(item_id % 20 as varchar) end as category_filter,
           case when item_id % 11 = 10 then 'n/a'
                when item_id % 4 = 0 then cast(2007 + item_id % 17 as varchar) end as year_filter
    from benchmark""")

_step("asked", ("question",), """
    select *, question
           || case when category_filter is null then '' else ' category ' || category_filter end
           || case when year_filter is null then '' else ' year ' || year_filter end as query_text
    from question""")

_step("asked_tf", ("asked",), rf"""
    select question_id, {_BUCKET} as bucket, cast(count(*) as bigint) as tf
    from (select question_id, unnest(regexp_extract_all(lower(query_text), '\S+')) as token from asked)
    group by all""")

_step("asked_norm", ("asked_tf",), """
    select question_id, cast(sum(tf * tf) as bigint) as squares from asked_tf group by question_id""")

_step("dots", ("asked_tf", "chunk_tf"), """
    select question_id, chunk_id, cast(sum(a.tf * c.tf) as bigint) as dot
    from asked_tf a join chunk_tf c using (bucket) group by all""")

_step("hit", ("asked_norm", "chunk_norm", "dots", "chunk"), f"""
    select question_id, rank, chunk.*, distance
    from (select question_id, chunk_id, distance,
                 row_number() over (partition by question_id order by distance, chunk_id) as rank
          from (select a.question_id, c.chunk_id,
                       greatest(1 - coalesce(d.dot, 0)
                                / sqrt(cast(a.squares * c.squares as double)), 0) as distance
                from asked_norm a cross join chunk_norm c
                left join dots d on d.question_id = a.question_id and d.chunk_id = c.chunk_id))
    join chunk using (chunk_id)
    where rank <= {NEIGHBOURS}""")

_step("judged", ("hit", "question"), """
    select h.*, (q.category_filter is null or h.category = trim(q.category_filter))
                and (try_cast(q.year_filter as bigint) is null
                     or h.year = try_cast(q.year_filter as bigint)) as fits
    from hit h join question q using (question_id)""")

_step("kept", ("judged",), """
    select * exclude (any_fits) from (
        select *, bool_or(fits) over (partition by question_id) as any_fits from judged)
    where fits or not any_fits""")

_step("source", ("kept",), """
    select question_id, row_number() over (partition by question_id order by rank) as position,
           arxiv_id, title, category, year, pub_status, distance
    from (select * from kept
          qualify row_number() over (partition by question_id, arxiv_id order by rank) = 1)
    qualify position <= 5""")

_step("point", ("kept",), """
    select question_id, place,
           title || ': ' || case when length(chunk_text) > 280
                                 then rtrim(substr(chunk_text, 1, 277)) || '...'
                                 else chunk_text end as line
    from (select *, row_number() over (partition by question_id order by rank) as place from kept)
    where place <= 3""")

_step("answer", ("question", "point", "source"), """
    select q.question_id, q.question,
           coalesce(p.text, 'No relevant evidence found for this query.') as answer,
           coalesce(s.n, 0) as source_count, 'hashed' as model_used,
           q.category_filter, q.year_filter
    from question q
    left join (select question_id, string_agg(line, ' ' order by place) as text
               from point group by question_id) p using (question_id)
    left join (select question_id, count(*) as n from source group by question_id) s
           using (question_id)""")

_step("dimension", (), """
    select vec_id, label, generate_subscripts(embedding, 1) as position,
           cast(unnest(embedding) as double) as x
    from embeddings""")

_step("centroid", ("dimension",), """
    select label, position, avg(x) as x from dimension group by all""")

_step("pair", ("dimension", "centroid"), """
    select c.label, d.vec_id,
           1 - sum(c.x * d.x) / sqrt(sum(c.x * c.x) * sum(d.x * d.x)) as distance
    from centroid c join dimension d using (position)
    group by c.label, d.vec_id""")

_step("plane", ("dimension",), f"""
    select plane, position,
           case when md5(plane || ':' || (position - 1)) < '8' then 1 else -1 end as side
    from range({BITS}) planes(plane), (select distinct position from dimension)""")

_step("vector_bit", ("dimension", "plane"), """
    select vec_id, plane, sum(x * side) > 0 as bit
    from dimension join plane using (position) group by vec_id, plane""")

_step("query_bit", ("centroid", "plane"), """
    select label, plane, sum(x * side) > 0 as bit
    from centroid join plane using (position) group by label, plane""")

_step("candidate", ("vector_bit", "query_bit"), f"""
    select label, vec_id
    from (select q.label, v.vec_id, count(*) filter (q.bit <> v.bit) as differing
          from query_bit q join vector_bit v using (plane) group by q.label, v.vec_id)
    qualify row_number() over (partition by label order by differing, vec_id) <= {DEPTH}""")

_step("nearest_found", ("pair", "candidate"), f"""
    select label, vec_id from pair join candidate using (label, vec_id)
    qualify row_number() over (partition by label order by distance, vec_id) <= {NEIGHBOURS}""")

_step("nearest_true", ("pair",), f"""
    select label, vec_id from pair
    qualify row_number() over (partition by label order by distance, vec_id) <= {NEIGHBOURS}""")


_GRID = f"floor(x / sqrt(sum(x * x) over (partition by {{key}})) * {SCALE} + 0.5)"

_step("grid", ("dimension",), f"""
    select vec_id, position, {_GRID.format(key="vec_id")} as z from dimension""")

_step("asked_grid", ("centroid",), f"""
    select label, position, {_GRID.format(key="label")} as z from centroid""")

_step("cell0", ("grid",), """
    select cell, position, z as c
    from (select vec_id, row_number() over (order by md5(cast(vec_id as varchar))) - 1 as cell
          from (select distinct vec_id from grid)) join grid using (vec_id)
    where cell < (select floor(sqrt(count(distinct vec_id)) + 0.5) from grid)""")

for _round in range(ROUNDS + 1):
    _step(f"placed{_round}", ("grid", f"cell{_round}"), f"""
    select vec_id, cell
    from (select vec_id, cell, sum(c * c - 2 * z * c) as d
          from grid join cell{_round} using (position) group by vec_id, cell)
    qualify row_number() over (partition by vec_id order by d, cell) = 1""")
    _step(f"cell{_round + 1}", ("grid", f"cell{_round}", f"placed{_round}"), f"""
    select cell, position, coalesce(mean, c) as c
    from cell{_round} left join (
        select cell, position, floor((2 * sum(z) + count(*)) / (2 * count(*))) as mean
        from placed{_round} join grid using (vec_id) group by cell, position) using (cell, position)""")

_CELLS, _PLACED = f"cell{ROUNDS}", f"placed{ROUNDS}"

_step("residual", ("grid", _CELLS, _PLACED), f"""
    select vec_id, position, cell, c, z - c as r, max(abs(z - c)) over (partition by cell) as reach
    from {_PLACED} join grid using (vec_id) join {_CELLS} using (cell, position)""")

_step("decoded", ("residual",), f"""
    select vec_id, position, cell,
           c - reach + floor((2 * floor((r + reach) * {STEPS} / (2 * reach + 1)) + 1) * (2 * reach + 1) / {2 * STEPS}) as y
    from residual""")

_step("probed", ("asked_grid", _CELLS, _PLACED), f"""
    select label, cell
    from (select label, cell, sum(c * c - 2 * z * c) as d
          from asked_grid join {_CELLS} using (position)
          where cell in (select cell from {_PLACED}) group by label, cell)
    qualify row_number() over (partition by label order by d, cell)
            <= (select ceil({PROBED_TENTHS} * count(distinct cell) / 10) from {_PLACED})""")

_step("coded", ("probed", "decoded", "asked_grid"), """
    select label, vec_id, sum(z * y) as score
    from probed join decoded using (cell) join asked_grid using (label, position) group by label, vec_id""")

_step("coded_found", ("coded", "pair"), f"""
    select label, vec_id from pair join (
        select label, vec_id from coded
        qualify row_number() over (partition by label order by score desc, vec_id) <= {CODED_DEPTH}) using (label, vec_id)
    qualify row_number() over (partition by label order by distance, vec_id) <= {NEIGHBOURS}""")


def _sample(limit: str) -> str:
    columns = ", ".join(f"coalesce(length({c.strip()}) || ':' || {c.strip()}, '-')" for c in _RAW_COLUMNS.split(","))
    return _query(
        f"""select {_RAW_COLUMNS} from raw
        qualify row_number() over (order by md5(concat_ws('|', '{SEED}', {columns}))) <= {limit}""",
        "raw",
    )


# Texts read as missing.
_MISSING = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)

ORACLES: dict[str, str] = {
    "raw_papers": _query(f"select {_RAW_COLUMNS} from raw", "raw"),
    "category_filter": _query(
        "select arxiv_id, categories, primary_category, updated from raw where "
        + " or ".join(
            f"list_contains(string_split(categories, ' '), '{c}')" for c in FILTER_CATEGORIES
        ),
        "raw",
    ),
    "dedup": _query("select * from unique_papers", "unique_papers"),
    "submitted_year": _query("select arxiv_id, submitted, submitted_year from years", "years"),
    "word_count": _query("select * from word_counts", "word_counts"),
    "author_count": _query("select * from name_counts", "name_counts"),
    "papers_clean": _query("select * from papers", "papers"),
    "category_stats": _query(
        """select primary_category as category, count(*) as total_papers,
                  count(*) filter (pub_status = 'published') as published_count,
                  round(100.0::double * count(*) filter (pub_status = 'published') / count(*), 2)
                      as publish_rate_pct
           from papers group by primary_category""",
        "papers",
    ),
    "yearly_trends": _query(
        """select submitted_year as year, primary_category as category, count(*) as paper_count
           from papers group by all""",
        "papers",
    ),
    "publication_status": _query(
        """select pub_status, primary_category as category, count(*) as paper_count
           from papers group by all""",
        "papers",
    ),
    "author_explode": _query("select * from paper_names", "paper_names"),
    "author_category": _query("select * from name_categories", "name_categories"),
    "author_top_category": _query("select * from name_tops", "name_tops"),
    "author_stats": _query(
        """select author, paper_count, first_year, last_year, top_category
           from (select author, count(*) as paper_count, min(submitted_year) as first_year,
                        max(submitted_year) as last_year from paper_names group by author)
           join name_tops using (author)""",
        "paper_names",
        "name_tops",
    ),
    "paper_listing": _query(
        f"""select *, count(*) over () as item_count
            from (select arxiv_id, title, primary_category as category, submitted_year as year,
                         case pub_status when 'published' then 'Published' else 'Preprint' end
                             as pub_status, first_author
                  from papers order by submitted_year desc, arxiv_id
                  limit {PAGE_LIMIT} offset {PAGE_OFFSET})""",
        "papers",
    ),
    "paper_listing_deep": _query(
        f"""select arxiv_id, title, primary_category as category, submitted_year as year,
                   case pub_status when 'published' then 'Published' else 'Preprint' end as pub_status, first_author
            from papers order by submitted_year desc, arxiv_id limit {PAGE_LIMIT} offset {DEEP_OFFSET}""",
        "papers",
    ),
    "chart_prep": _query(
        """select arxiv_id, primary_category, pub_status, submitted_year, abstract_word_count
           from papers""",
        "papers",
    ),
    "top_categories": _query("select * from top5", "top5"),
    "category_pivot": _query(
        """select category, published, unpublished, published + unpublished as total,
                  published as unpublished_base
           from (select primary_category as category,
                        count(*) filter (pub_status = 'published') as published,
                        count(*) filter (pub_status = 'unpublished') as unpublished
                 from papers group by primary_category)""",
        "papers",
    ),
    "year_trend_top5": _query(
        """select y.year, g.category_group, count(p.arxiv_id) as paper_count
           from (select distinct submitted_year as year from papers) y
           cross join (select category as category_group from top5 union all select 'Other') g
           left join grouped p
             on p.submitted_year = y.year and p.category_group = g.category_group
           group by all""",
        "grouped",
    ),
    "status_share": _query(
        """select d.s as pub_status, d.label, count(p.arxiv_id) as paper_count,
                  round(100.0::double * count(p.arxiv_id) / (select count(*) from papers), 1)
                      as share_pct
           from (values ('published', 'Published'), ('unpublished', 'Unpublished')) d(s, label)
           left join papers p on p.pub_status = d.s group by all""",
        "papers",
    ),
    "length_histogram": _query(
        """select e.category_group, e.i as bin, round(e.left_edge, 6) as left_edge,
                  round(e.right_edge, 6) as right_edge, count(g.arxiv_id) as row_count,
                  round(count(g.arxiv_id) / (e.right_edge - e.left_edge) / e.total, 6) as density
           from edges e left join grouped g
             on g.category_group = e.category_group and g.abstract_word_count >= e.left_edge
            and (g.abstract_word_count < e.right_edge or e.i = 29)
           group by e.category_group, e.i, e.left_edge, e.right_edge, e.total""",
        "edges",
    ),
    "index_eligible": _query("select * from eligible", "eligible"),
    "chunks": _query("select * from chunk", "chunk"),
    "chunk_append": _query(
        """select chunk_id, arxiv_id, chunk_text from old_chunk
           union all
           select chunk_id, arxiv_id, chunk_text from chunk
           where chunk_id not in (select chunk_id from old_chunk)""",
        "chunk",
        "old_chunk",
    ),
    "index_summary": _query(
        "select count(distinct arxiv_id) as papers, count(*) as chunks from chunk", "chunk"
    ),
    "hashed_tf": _query("select * from chunk_tf", "chunk_tf"),
    "embed_postings": _query(
        """select chunk_id, bucket, round(tf / sqrt(cast(squares as double)), 6) as weight
           from chunk_tf join chunk_norm using (chunk_id)""",
        "chunk_norm",
    ),
    "l2_normalize": _query(
        """select vec_id, position, round(x / sqrt(sum(x * x) over (partition by vec_id)), 6) as value
           from dimension""",
        "dimension",
    ),
    "knn_vectors": _query(
        f"""select label, rank, vec_id, round(distance, 6) as distance
            from (select label, vec_id, distance,
                         row_number() over (partition by label order by distance, vec_id) as rank
                  from (select cast(c.label as varchar) as label, d.vec_id,
                               1 - sum(c.x * d.x) / sqrt(sum(c.x * c.x) * sum(d.x * d.x)) as distance
                        from centroid c join dimension d using (position)
                        group by c.label, d.vec_id))
            where rank <= {NEIGHBOURS}""",
        "centroid",
    ),
    "ann_recall": _query(
        """select expected, found, round(found / expected, 6) as recall,
                  round(searched / pairs, 6) as searched_share
           from (select (select count(*) from nearest_true) as expected,
                        (select count(*) from nearest_true join nearest_found using (label, vec_id)) as found,
                        (select count(*) from candidate) as searched,
                        (select count(*) from pair) as pairs)""",
        "nearest_true",
        "nearest_found",
    ),
    "inverted_recall": _query(
        f"""select expected, found, round(found / expected, 6) as recall,
                  round(coded / pairs, 6) as coded_share, round(measured / pairs, 6) as measured_share,
                  round((coded / 8 + measured) / pairs, 6) as bytes_share
           from (select (select count(*) from nearest_true) as expected,
                        (select count(*) from nearest_true join coded_found using (label, vec_id)) as found,
                        (select count(*) from coded) as coded,
                        (select sum(least(n, {CODED_DEPTH})) from (select count(*) as n from coded group by label)) as measured,
                        (select count(*) from pair) as pairs)""",
        "nearest_true",
        "coded_found",
    ),
    "query_text": _query("select question_id, query_text from asked", "asked"),
    **dict.fromkeys(
        ("knn_text", "knn_organised"),
        _query(
            """select question_id, rank, chunk_id, chunk_text, arxiv_id, title, category, year,
                      pub_status, first_author, round(distance, 6) as distance
               from hit""",
            "hit",
        ),
    ),
    "knn_blocks": _query(
        "select question_id, rank, chunk_id, round(distance, 6) as distance from hit", "hit"
    ),
    "rag_filter": _query(
        """select question_id, rank, chunk_id, category, year, round(distance, 6) as distance
           from kept""",
        "kept",
    ),
    "rag_sources": _query(
        "select * replace (round(distance, 6) as distance) from source", "source"
    ),
    "answers": _query("select * from answer", "answer"),
    "grade_answers": _query(
        r"""select question_id, hits as keyword_hits, cast(2 as bigint) as min_keyword_hits,
                   hits >= 2 as passed
            from (select question_id,
                         count(*) filter (contains(lower(answer), lower(word))) as hits
                  from (select question_id, answer,
                               unnest(list_distinct(regexp_extract_all(question, '\S+'))) as word
                        from answer)
                  group by question_id)""",
        "answer",
    ),
    "sample_n": _sample(str(SAMPLE_SIZE)),
    "sample_frac": _sample(f"(select round_even({SAMPLE_FRAC} * count(*), 0) from raw)"),
    "csv_ingest": _query(
        "select "
        + ", ".join(
            f"case when {c.strip()} not in ({_MISSING}) then {c.strip()} end as {c.strip()}"
            for c in _RAW_COLUMNS.split(",")
        )
        + " from raw",
        "raw",
    ),
    "paper_listing_after": _query(
        f"""select arxiv_id, title, primary_category as category, submitted_year as year,
                   case pub_status when 'published' then 'Published' else 'Preprint' end as pub_status,
                   first_author
            from papers
            where submitted_year < {PAGE_AFTER[0]}
               or submitted_year = {PAGE_AFTER[0]} and arxiv_id > '{PAGE_AFTER[1]}'
            order by submitted_year desc, arxiv_id limit {PAGE_LIMIT}""",
        "papers",
    ),
    "questions_source": _query(
        r"""select q.question_id, b.text as question, q.category_filter, q.year_filter,
                   'keyword_match' as grading_type,
                   (select string_agg(w, '|' order by place)
                    from (select w, min(place) as place
                          from (select unnest(words) as w, unnest(range(len(words))) as place
                                from (select regexp_extract_all(b.text, '\S+') as words))
                          group by w)) as keywords,
                   cast(2 as bigint) as min_keyword_hits
            from question q join benchmark b on b.item_id = q.question_id""",
        "question",
    ),
    "table_refresh": _query(
        """select 'papers' as table_name, arxiv_id as key, pub_status as detail,
                  abstract_word_count as number from papers
           union all
           select 'category_stats', primary_category,
                  cast(round(100.0::double * count(*) filter (pub_status = 'published') / count(*), 2) as varchar),
                  count(*) from papers group by primary_category
           union all
           select 'yearly_trends', primary_category, cast(submitted_year as varchar), count(*)
           from papers group by primary_category, submitted_year
           union all
           select 'publication_status', primary_category, pub_status, count(*)
           from papers group by primary_category, pub_status
           union all
           select 'author_stats', author, top_category, count(*)
           from paper_names join name_tops using (author) group by author, top_category""",
        "paper_names",
        "name_tops",
    ),
    "collections": _query(
        """select 'papers_chunks' as collection, arxiv_id, count(*) as chunks from chunk group by arxiv_id
           union all
           select 'recent', arxiv_id, count(*) from chunk where pub_status = 'Published' group by arxiv_id""",
        "chunk",
    ),
    "index_health": _query(
        """select 'ok' as status, count(*) as index_chunks, 'papers_chunks' as collection,
                  'hashed' as embedding_backend from chunk""",
        "chunk",
    ),
    "external_embed": _query(
        f"""select chunk_id, position, round(x / sqrt(sum(x * x) over (partition by chunk_id)), 6) as value
            from (select chunk_id, cast(0 as bigint) + 1 as position, cast(length(chunk_text) as double) as x
                  from chunk
                  union all
                  select chunk_id, i + 1,
                         cast(length(chunk_text) - length(replace(chunk_text, '{LETTERS}'[i], '')) as double)
                  from chunk, range(1, {len(LETTERS) + 1}) r(i))""",
        "chunk",
    ),
    "external_answers": _query(
        f"""select question_id, failed,
                   case when failed
                        then 'Query failed: embedding request failed after 2 attempts: refused' end as failure,
                   not failed as has_sources, 'letters' as model_used
            from (select question_id, contains(query_text, '{REFUSED}') as failed from asked)""",
        "asked",
    ),
}

# The same rows, reached another way.
ORACLES["external_cached"] = ORACLES["external_embed"]
