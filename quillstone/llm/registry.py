"""Queries of the training-data operators and their SQL."""

from . import bpe, ctw, decontamination, exact, language, lines, near, packing, secrets, sharding, timestamps, warc, whitening

QUERIES = {
    "op1_content_sort": exact.op1_content_sort,
    "op2_extendible": sharding.op2_extendible,
    "op3_chosen_path": near.op3_chosen_path,
    "op4_byte_cnn": language.op4_byte_cnn,
    "op5_bpe": bpe.op5_bpe,
    "op6_line_frequency": lines.op6_line_frequency,
    "op7_ctw": ctw.op7_ctw,
    "op8_secrets": secrets.op8_secrets,
    "op9_hilbert": packing.op9_hilbert,
    "op10_warc": warc.op10_warc,
    "op11_timestamps": timestamps.op11_timestamps,
    "op12_whitening": whitening.op12_whitening,
    "op13_decontaminate": decontamination.op13_decontaminate,
}
ORACLE_SQL = {
    "op1_content_sort": exact.OP1_SQL,
    "op2_extendible": sharding.OP2_SQL,
    "op6_line_frequency": lines.OP6_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_timestamps": timestamps.OP11_SQL,
    "op13_decontaminate": decontamination.OP13_SQL,
}
