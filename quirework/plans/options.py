"""Options of a recognition run, their defaults and their checks."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Options:
    """What a run does. Options that only place work (devices, workers, precision) belong to Spark's configuration:
    they are accepted by ``make`` and reported, but change no result."""

    input_folder: str | None = None
    detector: str = "rfdetr"  # rfdetr, paddle or none
    detection_model_path: str | None = None
    paddle_layout_model_path: str | None = None
    paddle_det_model_path: str | None = None
    recognition_model_path: str | None = None
    processor_path: str | None = None
    cyrillic_recognition_model_path: str | None = None
    cyrillic_processor_path: str | None = None
    script_classification_model_path: str | None = None
    use_ppocr: bool = False
    ppocr_model_path: str | None = None
    ppocr_char_dict_path: str | None = None
    region_model_name: str = "Default"
    line_model_name: str = "Default"
    text_rec_model_name: str = "Default"
    cyrillic_text_rec_model_name: str = "Default"
    script_classification_model_name: str = "Default"
    trocr_batch_size: int = 8
    classifier_batch_size: int = 32
    ppocr_batch_size: int = 32
    tile_batch_size: int = 3
    classifier_default_label: str = "latin"
    page_xml: int = 0
    alto_xml: int = 1
    output_json: int = 1
    xml_folder: str | None = None
    json_folder: str | None = None
    confidence_threshold: float = 0.15
    line_percentage_threshold: float = 7e-05
    region_percentage_threshold: float = 7e-05
    line_iou: float = 0.3
    region_iou: float = 0.3
    line_overlap_threshold: float = 0.5
    region_overlap_threshold: float = 0.5
    sliver_threshold: float = 0.01
    tile_size: int = 0
    tile_overlap: int = 128
    tiles_across: int = 2
    tile_iou_threshold: float = 0.85
    ppocr_img_height: int = 96
    ppocr_img_width_min: int = 320
    ppocr_img_width_max: int = 3200
    ppocr_width_buckets: tuple[int, ...] | None = None
    paddle_layout_threshold: float = 0.3
    paddle_layout_input_size: int = 0
    paddle_layout_mean: tuple[float, ...] = (0.0, 0.0, 0.0)
    paddle_layout_std: tuple[float, ...] = (1.0, 1.0, 1.0)
    paddle_layout_boxes_in_input_space: bool = False
    paddle_layout_labels_path: str | None = None
    paddle_layout_ignore_classes: tuple[str, ...] = ()
    paddle_det_limit_side_len: int = 1536
    paddle_det_limit_type: str = "max"
    paddle_det_max_side_limit: int = 4000
    paddle_det_thresh: float = 0.3
    paddle_det_box_thresh: float = 0.6
    paddle_det_unclip_ratio: float = 1.5
    reading_direction: str = "lr"
    ignored: tuple[str, ...] = field(default=(), repr=False)


# Options that place work and have no meaning of their own here.
PLACEMENT = (
    "device", "gpu_ids", "workers_per_gpu", "cpu_processes", "inference_in_flight_limit", "split_workers", "fp16_rec", "fp16_det",
    "enable_tensorrt", "no_trt_dynamic_shapes", "ppocr_trt_opt_width", "ppocr_pad_batch", "paddle_det_trt_opt_shape",
)


def make(**options) -> Options:
    """Options from keywords; an unknown name is a TypeError."""
    known = {f.name for f in fields(Options)} - {"ignored"}
    unknown = set(options) - known - set(PLACEMENT)
    if unknown:
        raise TypeError(f"unknown options: {', '.join(sorted(unknown))}")
    return Options(**{k: v for k, v in options.items() if k in known}, ignored=tuple(sorted(set(options) & set(PLACEMENT))))


def check(o: Options, given: bool = False) -> list[str]:
    """Notes on a valid set of options; a ValueError for one that cannot run. ``given``: models are passed, not paths."""
    if o.detector not in ("rfdetr", "paddle", "none"):
        raise ValueError(f"unknown detector {o.detector!r}")
    if o.reading_direction not in ("lr", "rl"):
        raise ValueError("reading_direction is lr or rl")
    if o.tile_size < 0 or o.tile_size and not 0 <= o.tile_overlap < o.tile_size:
        raise ValueError("tiles must be larger than their overlap")
    if given:
        return []
    if o.detector == "paddle" and not o.paddle_det_model_path:
        raise ValueError("the paddle detector needs a line model")
    latin = bool(o.ppocr_model_path if o.use_ppocr else o.recognition_model_path)
    cyrillic = bool(o.cyrillic_recognition_model_path)
    if not latin and not cyrillic:
        raise ValueError("at least one recognizer is needed")
    if latin and not o.use_ppocr and not o.processor_path or cyrillic and not o.cyrillic_processor_path:
        raise ValueError("a recognizer lacks its processor")
    if latin and o.use_ppocr and not o.ppocr_char_dict_path:
        raise ValueError("the recognizer lacks its dictionary")
    if latin and cyrillic and not o.script_classification_model_path:
        raise ValueError("two recognizers need a script classifier")
    return [] if latin and cyrillic else [f"only {'latin' if latin else 'cyrillic'} lines can be read; all lines go to that recognizer"]
