"""Table operators: keys, frames, allocation, sampling, intake, release, browsing."""
