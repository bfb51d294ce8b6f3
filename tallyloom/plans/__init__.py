"""Multi-step jobs: presets, training, model selection."""
