"""Signature and stamp boxes: filters, overlap, suppression, summaries, label files."""

from __future__ import annotations

from ..functions import bank
from ..functions.scalars import iou
from .validate import validated_boxes

CLASSES = ("signature", "stamp")


def filtered(source: str = "detections", images: str = "images") -> dict[str, str]:
    """Boxes clipped to their image (doc, width, height), by confidence of their class and by their share of its area."""
    low, high = bank.DETECTION_AREA
    least = "case class_name " + " ".join(f"when '{k}' then {v}e0" for k, v in bank.DETECTION_CONFIDENCE.items()) + " else 0.5e0 end"
    inside = lambda c, most: f"greatest(0e0, least({c}, {most})) as {c}"
    return {
        "clipped": f"select s.doc, det_idx, class_name, confidence, width, height, {inside('x1', 'width')}, {inside('y1', 'height')}, {inside('x2', 'width')}, {inside('y2', 'height')} from {source} s join {images} i on s.doc = i.doc",
        "boxes": "select *, (x2 - x1) * (y2 - y1) as area, (x1 + x2) / 2 as cx, (y1 + y2) / 2 as cy from clipped",
        "passed": f"select * from boxes where confidence >= {least} and area between {low:.6f}e0 * (width * height) and {high}e0 * (width * height)",
    }


def kept_boxes(d, source: str = "passed", most: float = 0.5) -> dict[str, str]:
    """By falling confidence, a box stays unless it overlaps one that stays by more than `most`. Classes don't matter."""
    if d.name == "spark":
        overlap = iou("b_.", "k_.")
        box = "named_struct('o', -confidence, 'det_idx', det_idx, 'class_name', class_name, 'confidence', confidence, 'x1', x1, 'y1', y1, 'x2', x2, 'y2', y2, 'area', area, 'width', width, 'height', height)"
        fold = f"aggregate(slice(a, 2, greatest(size(a) - 1, 0)), slice(a, 1, 1), (s_, b_) -> if(exists(s_, k_ -> {overlap} > {most}e0), s_, array_append(s_, b_)))"
        return {
            "sorted_boxes": f"select doc, array_sort(collect_list({box})) as a from {source} group by doc",
            "kept": f"select doc, k.det_idx as det_idx, k.class_name as class_name, k.confidence as confidence, k.x1 as x1, k.y1 as y1, k.x2 as x2, k.y2 as y2, k.area as area, k.width as width, k.height as height from (select doc, explode({fold}) as k from sorted_boxes) t",
        }
    overlap = iou("b.", "k_.")
    box = "struct_pack(x1 := b.x1, y1 := b.y1, x2 := b.x2, y2 := b.y2)"
    return {
        "numbered": f"select *, row_number() over (partition by doc order by -confidence, det_idx) as n from {source}",
        "folded": f"""with recursive f(doc, n, stays, kept) as (
            select doc, n, true, [{box}] from numbered b where n = 1
            union all select b.doc, b.n, len(list_filter(f.kept, lambda k_: {overlap} > {most})) = 0,
              case when len(list_filter(f.kept, lambda k_: {overlap} > {most})) = 0 then list_append(f.kept, {box}) else f.kept end
            from f join numbered b on b.doc = f.doc and b.n = f.n + 1) select doc, n from f where stays""",
        "kept": "select b.doc, det_idx, class_name, confidence, x1, y1, x2, y2, area, width, height from numbered b join folded f on b.doc = f.doc and b.n = f.n",
    }


def summary(d, images: str = "images", truth: str = "true_boxes") -> dict[str, str]:
    """For each image and class the best box, the count, and the overlap with the true box, where there is one.

    by_class has a row for each class that was found; box_summary one for each image. Images with truth pass if every class that the truth holds overlaps by more than a half.
    """
    order = d.struct(a="-confidence", b="det_idx")
    best = {c: d.first_by(c, order) for c in ("x1", "y1", "x2", "y2")}
    pick = lambda c, k: f"max(case when class_name = '{k}' then {c} end)"
    wide = ", ".join(f"{pick('n', k)} as {k}_n, {pick('confidence', k)} as {k}_best, {pick('adjusted', k)} as {k}_adjusted, {pick('iou', k)} as {k}_iou, {', '.join(f'{pick(c, k)} as {k}_{c}' for c in best)}" for k in CLASSES)
    out = ", ".join(f"{k}_n is not null as {k}_present, coalesce({k}_n, 0) as {k}_count, coalesce({k}_best, 0e0) as {k}_confidence, {k}_adjusted, {k}_iou, {', '.join(f'{k}_{c}' for c in best)}" for k in CLASSES)
    due = ", ".join(f"max(case when class_name = '{k}' then 1 else 0 end) = 1 as due_{k}" for k in CLASSES)
    passes = " and ".join(f"(not due_{k} or coalesce({k}_iou, 0e0) > 0.5e0)" for k in CLASSES)
    return {
        "by_class": f"select doc, class_name, cast(count(*) as bigint) as n, max(confidence) as confidence, {', '.join(f'{v} as {c}' for c, v in best.items())} from kept group by doc, class_name",
        **validated_boxes(),
        "overlapped": f"select b.*, case when t.doc is not null then {iou('b.', 't.')} end as iou from box_rules b left join {truth} t on b.doc = t.doc and b.class_name = t.class_name",
        "found_boxes": f"select doc, {wide} from overlapped group by doc",
        "due_boxes": f"select doc, {due} from {truth} group by doc",
        "box_summary": f"select i.doc, {out}, case when u.doc is not null then {passes} end as passes_threshold from {images} i left join found_boxes f on i.doc = f.doc left join due_boxes u on i.doc = u.doc",
    }


def label_line(d) -> str:
    """K9: class, centre and size as shares of the image, six places."""
    n = lambda x, w: f"format_string('%.6f', {x} / {w})" if d.name == "spark" else f"printf('%.6f', {x} / {w})"
    return f"concat(case class_name when 'signature' then '0 ' else '1 ' end, {n('((x1 + x2) / 2)', 'width')}, ' ', {n('((y1 + y2) / 2)', 'height')}, ' ', {n('(x2 - x1)', 'width')}, ' ', {n('(y2 - y1)', 'height')})"


def split(images: str = "images", ratio: float = 0.8) -> dict[str, str]:
    """The first `ratio` of the images in order train, the others validate. Places are summed by buckets of the names' first characters, so no task orders all images."""
    return {
        "bucketed": f"select doc, substring(doc, 1, 8) as bucket from {images}",
        "buckets": "select bucket, cast(count(*) as bigint) as n from bucketed group by bucket",
        "offsets": "select bucket, sum(n) over (order by bucket) - n as before_, sum(n) over () as total from buckets",
        "placed_images": "select b.doc, o.before_ + row_number() over (partition by b.bucket order by b.doc) as place, o.total from bucketed b join offsets o on b.bucket = o.bucket",
        "parts": f"select doc, cast(place as bigint) as place, case when place <= floor(total * {ratio}e0) then 'train' else 'val' end as part from placed_images",
    }
