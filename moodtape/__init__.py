"""moodtape: does the mood of the news lead the tape?

Spark jobs that land price bars and articles, score the articles, roll the
scores up per instrument and day, join them to returns and correlate the two at
several lags.  Everything is a DataFrame in, DataFrame out function; see README.
"""
