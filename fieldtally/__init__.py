"""Campaign monitoring analytics on Spark: raw form submissions in, tidy reporting tables out."""
