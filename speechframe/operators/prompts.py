"""Prompts for the annotator: one template per source and four generic ones."""

from pyspark.sql import Column, DataFrame, functions as F

# The generic prompt texts.
AUDIO_MARK = "<|audio_bos|><|AUDIO|><|audio_eos|>"

GENERIC_PROMPTS = {
    "analysis": AUDIO_MARK
    + """Please provide a detailed analysis of this voice recording. Focus on:

1. **Voice Characteristics**: Describe the tone, pitch, timbre, and overall quality of the voice. Is it deep, high-pitched, raspy, smooth, breathy, nasal, clear, or muffled?

2. **Speaking Style**: How does the person speak? Is it fast or slow? Are they articulate or mumbling? Do they have a formal or casual speaking style? Any notable pauses or hesitations?

3. **Emotional Tone**: What emotions or mood can you detect in the voice? Does the speaker sound confident, nervous, happy, sad, excited, calm, tired, or energetic?

4. **Distinctive Features**: Are there any unique characteristics that make this voice memorable? Any vocal quirks, speech patterns, or notable pronunciations?

5. **Voice Age and Maturity**: Based on vocal characteristics alone, describe the perceived age or maturity level of the voice.

6. **Overall Impression**: How would you help someone imagine this voice if they wanted to recreate or find a similar voice? What kind of person or character would have this voice?

Please provide a comprehensive description that would help someone vividly imagine this voice.""",
    "character": AUDIO_MARK
    + """Based on this voice recording, describe what kind of character or persona this voice would suit. Consider:

- What type of character in a story, game, or animation would have this voice?
- What profession or role would match this voice?
- What personality traits does this voice suggest?
- In what context would this voice be most fitting?

Provide a creative but grounded character description based solely on the vocal qualities.""",
    "technical": AUDIO_MARK
    + """Provide a technical analysis of this voice recording:

1. **Frequency Range**: Estimate the fundamental frequency range and dominant frequencies
2. **Voice Quality**: Identify technical qualities (breathiness, roughness, strain, resonance)
3. **Articulation**: Assess clarity of consonants, vowel quality, and overall intelligibility
4. **Prosody**: Analyze rhythm, intonation patterns, stress patterns, and pacing
5. **Acoustic Features**: Note any specific acoustic characteristics that stand out

Focus on objective, measurable aspects of the voice.""",
    "combined": AUDIO_MARK
    + """Analyze this voice recording comprehensively:

**Part 1 - Voice Profile:**
- Physical characteristics (pitch, tone, timbre, quality)
- Speaking patterns and style
- Emotional undertones and energy level

**Part 2 - Character Match:**
- What character or persona fits this voice?
- Suitable contexts and applications

**Part 3 - Unique Identifiers:**
- Distinctive features that make this voice memorable
- How to recreate or find similar voices

Provide a detailed description that captures the essence of this voice for creative applications.""",
}

# The source prompt texts. Braces name the columns that are filled in.
SOURCE_PROMPTS = {
    "globe_v2": """Analyze this voice recording for character consistency. Speaker: {gender} in {age}, {accent} accent.

Describe the speaker's NATURAL voice characteristics - how they inherently sound, not what emotions they're expressing.

Provide a detailed voice profile covering:

**Pitch Range**: Natural speaking pitch (high/medium/low/deep)
**Tone Quality**: Warm/cool, bright/dark, rich/thin\x20\x20
**Timbre**: Smooth/raspy/breathy/nasal/clear/gravelly
**Resonance**: Chest voice/head voice/throaty/forward placement
**Speaking Rhythm**: Natural pace, pauses, flow patterns
**Articulation Style**: Crisp/relaxed/precise/casual
**Vocal Texture**: Any unique qualities (vocal fry, breathiness, etc.)

Example: "Medium-low pitch with warm, slightly raspy timbre. Speaks with measured pace and clear articulation. Voice has natural chest resonance with slight breathiness. Tends to emphasize consonants crisply."

Focus on replicable voice characteristics, not the emotional content of this recording.""",
    "laions": """Analyze this voice recording for character consistency. Emotional context: {emotion}.

Describe the speaker's UNDERLYING voice characteristics - their natural voice qualities beneath any emotional expression.

**Required Format:**
GENDER: [male/female]
AGE: [teens/twenties/thirties/forties/fifties+]
ACCENT: [specific accent like "General American", "British RP", "Australian" - never "neutral"]
VOICE_PROFILE: [detailed description]

**Voice Profile Should Include:**
- **Pitch Range**: Natural speaking pitch (high/medium/low/deep)
- **Tone Quality**: Warm/cool, bright/dark, rich/thin
- **Timbre**: Smooth/raspy/breathy/nasal/clear/gravelly\x20\x20
- **Resonance**: Chest voice/head voice/throaty/forward placement
- **Speaking Rhythm**: Natural pace, pauses, flow patterns
- **Articulation Style**: Crisp/relaxed/precise/casual
- **Vocal Texture**: Any unique qualities

Example: "High-medium pitch with bright, clear timbre. Natural speaking rhythm is quick but controlled. Voice has forward resonance with crisp articulation."

Ignore the emotional performance - focus on the speaker's inherent vocal characteristics that remain consistent.""",
    "animevox": """Analyze this anime voice recording for character consistency. Character: {character_name} from {anime}.

Describe the voice actor's natural vocal characteristics, not the character they're portraying.

**Required Format:**
GENDER: [male/female]\x20
AGE: [teens/twenties/thirties/forties/fifties+]
ACCENT: [specific accent like "Japanese-accented English", "General American" - never "neutral"]
VOICE_PROFILE: [detailed description]

**Voice Profile Should Include:**
- **Pitch Range**: Natural vocal range and placement
- **Tone Quality**: Warm/cool, bright/dark, rich/thin
- **Timbre**: Smooth/raspy/breathy/nasal/clear/gravelly
- **Resonance**: Chest voice/head voice/throaty/forward placement\x20\x20
- **Speaking Rhythm**: Natural pace, pauses, flow patterns
- **Articulation Style**: Crisp/relaxed/precise/casual
- **Performance Style**: How they approach voice acting
- **Vocal Texture**: Any unique qualities

Example: "Medium-high pitch with youthful, bright timbre. Uses head-voice resonance with slight breathiness. Quick, animated speaking style with exaggerated vowel sounds."

Focus on the voice actor's consistent vocal qualities regardless of which character they voice.""",
    "anispeech": """Analyze this anime speech recording for character consistency. Voice class: {voice_class}.

Describe the speaker's natural vocal characteristics for voice consistency across productions.

**Required Format:**
GENDER: [male/female]
AGE: [teens/twenties/thirties/forties/fifties+]
ACCENT: [specific accent like "Japanese", "Japanese-accented English", "General American" - never "neutral"]
VOICE_PROFILE: [detailed description]

**Voice Profile Should Include:**
- **Pitch Range**: Natural speaking pitch (high/medium/low/deep)
- **Tone Quality**: Warm/cool, bright/dark, rich/thin
- **Timbre**: Smooth/raspy/breathy/nasal/clear/gravelly
- **Resonance**: Chest voice/head voice/throaty/forward placement
- **Speaking Rhythm**: Natural pace, pauses, flow patterns\x20\x20
- **Articulation Style**: Crisp/relaxed/precise/casual
- **Voice Classification**: How voice fits its designated class
- **Vocal Texture**: Any unique qualities

Example: "Medium pitch with clear, youthful timbre. Forward resonance with precise articulation. Animated speaking style typical of anime voice work."

Focus on voice characteristics that define this speaker's unique vocal identity.""",
}


def template_parts(template: str) -> list[tuple[str, bool]]:
    """Split a template into (text, is_column) pieces."""
    pieces = []
    for chunk in template.split("{"):
        name, brace, rest = chunk.partition("}")
        if brace:
            pieces += [(name, True), (rest, False)]
        else:
            pieces.append((name, False))
    return [p for p in pieces if p[0]]


def _filled(df: DataFrame, template: str) -> Column:
    """A missing column reads 'unknown', a null value 'None'."""

    def piece(text, is_column):
        if not is_column:
            return F.lit(text)
        return F.coalesce(F.col(text).cast("string"), F.lit("None")) if text in df.columns else F.lit("unknown")

    return F.concat(*[piece(*p) for p in template_parts(template)])


def build_prompt(df: DataFrame, column: str = "prompt") -> DataFrame:
    """The prompt of every row, by its ``dataset``; another dataset gives null."""
    names = iter(SOURCE_PROMPTS.items())
    name, template = next(names)
    chosen = F.when(F.col("dataset") == name, _filled(df, template))
    for name, template in names:
        chosen = chosen.when(F.col("dataset") == name, _filled(df, template))
    return df.withColumn(column, chosen)


def prompt_by_type(df: DataFrame, kind: str = "analysis", column: str = "prompt") -> DataFrame:
    if kind not in GENERIC_PROMPTS:
        raise ValueError(f"Invalid prompt type. Choose from: {list(GENERIC_PROMPTS)}")
    return df.withColumn(column, F.lit(GENERIC_PROMPTS[kind]))
