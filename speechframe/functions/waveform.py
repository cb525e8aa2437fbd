"""Waveform columns: native higher-order functions over array<float>."""

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from speechframe.functions.scalars import _col


def unify_audio(df, column: str, default_rate: int = 16000) -> Column:
    """An ``array``/``sampling_rate`` struct from either a struct column or a bare array."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        samples, rate = F.col(column)["array"], F.col(column)["sampling_rate"].cast("int")
    else:
        samples = F.col(column)
        rate = F.when(samples.isNotNull(), F.lit(default_rate))
    return F.when(
        F.col(column).isNotNull(),
        F.struct(samples.cast("array<float>").alias("array"), rate.alias("sampling_rate")),
    )


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression named inside a lambda is otherwise computed again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def to_mono(frames) -> Column:
    """Mean across the channels of every frame."""
    return F.transform(
        _col(frames),
        lambda f: (F.aggregate(f, F.lit(0.0), lambda a, x: a + x) / F.size(f)).cast("float"),
    )


def clip(samples, rate, seconds: float) -> Column:
    """The first ``int(seconds * rate)`` samples."""
    keep = F.floor(F.lit(float(seconds)) * _col(rate)).cast("int")
    return F.slice(_col(samples), F.lit(1), keep)


def peak(samples) -> Column:
    return F.array_max(F.transform(_col(samples), lambda x: F.abs(x)))


def peak_normalize(samples) -> Column:
    """Divide by the largest magnitude; a silent clip gives null elements."""
    scaled = lambda s: bind(
        peak(s).cast("double"), lambda top: F.transform(s, lambda x: F.try_divide(x.cast("double"), top))
    )
    return bind(_col(samples), scaled)


def _frame_rms(samples: Column, frame: int, hop: int) -> Column:
    size = F.size(samples)

    def rms(i: Column) -> Column:
        start = i * F.lit(hop) - F.lit(frame // 2)
        first = F.greatest(start, F.lit(0))
        length = F.greatest(F.least(start + F.lit(frame), size) - first, F.lit(0))
        inside = F.slice(samples, (first + F.lit(1)).cast("int"), length.cast("int"))
        energy = F.aggregate(inside, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        return F.sqrt(energy / F.lit(float(frame)))

    return F.transform(F.sequence(F.lit(0), F.floor(size / F.lit(hop)).cast("int")), rms)


def frame_rms(samples, frame: int = 2048, hop: int = 512) -> Column:
    """RMS of centred frames; the clip is zero-padded by half a frame at both ends."""
    return bind(_col(samples), lambda s: _frame_rms(s, frame, hop))


def rms_energy(samples, frame: int = 2048, hop: int = 512) -> Column:
    """Mean of the framed RMS."""
    mean = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)
    return bind(frame_rms(samples, frame, hop), mean)


def _loud_range(levels: Column, size: Column, hop: int, top_db: float) -> Column:
    """Start and end sample of the part louder than the loudest frame minus ``top_db``."""
    # 1e-10 is the power floor of the decibel scale
    power = lambda x: F.greatest(x * x, F.lit(1e-10))
    is_loud = lambda top: F.transform(levels, lambda x: F.log10(power(x) / top) * F.lit(10.0) > F.lit(-float(top_db)))

    def cut(loud):
        first = F.array_position(loud, F.lit(True)) - F.lit(1)
        last = F.size(loud) - F.array_position(F.reverse(loud), F.lit(True)) + F.lit(1)
        return F.struct(
            (first * F.lit(hop)).cast("int").alias("start"),
            F.least(last * F.lit(hop), size).cast("int").alias("end"),
        )

    return bind(bind(power(F.array_max(levels)), is_loud), cut)


def trim_silence(samples, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> Column:
    """Cut frames quieter than the loudest one minus ``top_db`` off both ends."""

    def kept(s):
        keep = lambda c: F.slice(s, c["start"] + F.lit(1), F.greatest(c["end"] - c["start"], F.lit(0)))
        found = lambda levels: bind(_loud_range(levels, F.size(s), hop, top_db), keep)
        return bind(_frame_rms(s, frame, hop), found)

    return bind(_col(samples), kept)


def duration_of(samples, rate) -> Column:
    return F.try_divide(F.size(_col(samples)).cast("double"), _col(rate))


def signal_stats(samples) -> Column:
    """min, max, mean and length of a waveform."""
    samples = _col(samples)
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.struct(
        F.array_min(samples).cast("double").alias("min"),
        F.array_max(samples).cast("double").alias("max"),
        F.try_divide(total, F.size(samples)).alias("mean"),
        F.size(samples).alias("length"),
    )


def preprocess(samples, rate, seconds: float = 10.0, top_db=60.0, frame=2048, hop=512, trim=True, channels=False) -> Column:
    """Mono, trim, clip and normalise; ``trim=False`` is the short form: mono and normalise.

    ``channels`` says that every element holds one value per channel.
    """
    sound = to_mono(samples) if channels else _col(samples)
    if trim:
        sound = clip(trim_silence(sound, top_db, frame, hop), rate, seconds)
    return peak_normalize(sound)
