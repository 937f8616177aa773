"""Blocks as lines of text."""

from __future__ import annotations


def line_groups(d, source: str = "invoice_blocks", most: int = 15) -> dict[str, str]:
    """Blocks by (y1, x1); a new line begins where y1 is more than `most` below the first block of the line."""
    if d.name == "spark":
        step = f"if(b_.y - element_at(s_, -1).anchor > {most}, array_append(s_, named_struct('idx', b_.idx, 'x', b_.x, 'anchor', b_.y, 'line', element_at(s_, -1).line + 1)), array_append(s_, named_struct('idx', b_.idx, 'x', b_.x, 'anchor', element_at(s_, -1).anchor, 'line', element_at(s_, -1).line)))"
        first = "transform(slice(a, 1, 1), f_ -> named_struct('idx', f_.idx, 'x', f_.x, 'anchor', f_.y, 'line', 0))"
        return {
            "page": f"select document_id, array_sort(collect_list(named_struct('y', y1, 'x', x1, 'idx', idx))) as a from {source} group by document_id",
            "lined": f"select document_id, l.idx as idx, l.line as line_no, l.x as x1 from (select document_id, explode(aggregate(slice(a, 2, greatest(size(a) - 1, 0)), {first}, (s_, b_) -> {step})) as l from page) t",
        }
    return {
        "page": f"select *, row_number() over (partition by document_id order by y1, x1, idx) as n from {source}",
        "lined": f"""with recursive f(document_id, n, idx, x1, anchor, line_no) as (select document_id, n, idx, x1, y1, 0 from page where n = 1
            union all select p.document_id, p.n, p.idx, p.x1, case when p.y1 - f.anchor > {most} then p.y1 else f.anchor end, case when p.y1 - f.anchor > {most} then f.line_no + 1 else f.line_no end
            from f join page p on p.document_id = f.document_id and p.n = f.n + 1) select document_id, idx, line_no, x1 from f""",
    }


def sequence(d, source: str = "invoice_blocks") -> dict[str, str]:
    """sequences(document_id, text): the words of a line from left to right, lines joined by a slash."""
    return {
        **line_groups(d, source),
        "placed_blocks": f"select l.document_id, l.line_no, l.x1, l.idx, b.text from lined l join {source} b on l.document_id = b.document_id and l.idx = b.idx",
        "one_line": f"select document_id, line_no, {d.ordered_join('text', d.struct(a='x1', b='idx'), ' ')} as line from placed_blocks group by document_id, line_no",
        "sequences": f"select document_id, {d.ordered_join('line', 'line_no', ' / ')} as text from one_line group by document_id",
    }
